"""Each operator against brute force, round trips or held-out labels, and the
odd cases: nulls, empty and long texts, ties, repeated rows, empty tables,
extra columns."""

import base64
import hashlib
import random
import re
import time
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from gridlake.llm import dom, langid, minhash, mixing, pseudo, qda, rules, spaced, substring, warc
from gridlake.llm.common import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, comp string"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def odd_rows():
    """Rows with the odd cases; the last two columns clash with inner names."""
    rng = random.Random(5)
    base = words(rng, 300)
    near = base.split()
    near[150] = "changed"
    passage = words(rng, 60)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "en", "b"), (4, None, "en", "b"), (5, "", None, None),
        (6, " \t\n ", "de", ""), (7, "one", "de", "b"), (8, "ONE", "de", "b"), (9, "one two three four", None, "c"),
        (10, words(rng, 40) + "\n" + passage + " " + words(rng, 30), "en", "a"), (11, passage + " tail", "fr", "a"),
        (12, words(rng, 25000, 3000), "en", "a"), (None, base, "en", "a"), (None, None, None, None), (13, "a " * 500, "en", "c"),
        (14, "a " * 90 + words(rng, 80), "en", "c"), (15, words(rng, 80) + " b" + " a" * 70, "en", "c"),
        (16, "Grüße an　alle", "de", "é"), (1, base, "en", "a"), (17, "x y " * 60, "fr", "c"), (18, "y " + "x y " * 70, "fr", "c"),
    ]
    return [(*r, len(r[1] or ""), 7, "z") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def split(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


# -- near-duplicates -------------------------------------------------------------

def brute_components(rows, percent=85):
    sets = []
    for _, text in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in split(text)]
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("which", ["odd", "small"])
def test_near_duplicates(request, which):
    df = request.getfixturevalue(which)
    got = minhash.near_duplicates(df).collect()
    want = brute_components([(r.doc_id, r.text) for r in df.collect()])
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_a_large_bucket(spark):
    """A chain of drifting copies: more than a block, most pairs under the threshold."""
    rng, text, rows = random.Random(1), words(random.Random(2), 120, 4000).split(), []
    for i in range(150):
        text = list(text)
        text[rng.randrange(len(text))] = f"new{i}"
        rows.append((i, " ".join(text)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows))


def test_likely_similarity():
    rng = np.random.default_rng(0)
    for j in (0.5, 0.8, 0.95):
        n = 2000
        both = int(2 * n * j / (1 + j))
        pool = np.unique(rng.integers(1, 1 << 52, 3 * n).astype(np.uint64))
        a, b = pool[:n], pool[n - both:2 * n - both]
        reg = minhash.registers(np.concatenate([a, b]), np.array([n, n]))
        got = minhash.likely_similarity(reg[:1], reg[1:], np.array([float(n)]), np.array([float(n)]))[0]
        assert abs(got - j) < 0.12


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, 1000 + i) for i in range(50)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long"), len(edges)).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


# -- substrings --------------------------------------------------------------------

def brute_repeats(rows):
    first = defaultdict(list)
    for d, text in rows:
        w = split(text)
        for k in range(len(w) - 49):
            if d is not None:
                first[tuple(w[k:k + 50])].append(d)
    out = []
    for d, text in rows:
        w = split(text)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if d is not None and min(first[tuple(w[k:k + 50])]) < d:
                gone[k:k + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("which", ["odd", "small"])
def test_repeats(request, which):
    df = request.getfixturevalue(which)
    got = sorted((tuple(r) for r in substring.dedup_substrings(df).collect()), key=str)
    assert got == sorted((x[:4] for x in brute_repeats([(r.doc_id, r.text) for r in df.collect()])), key=str)


def test_repeats_among_runs_and_periods(spark):
    rng, rows = random.Random(9), []
    parts = [" ".join("ab"[i % 2] for i in range(60)), "c " * 55, words(rng, 52, 30), words(rng, 49, 30), "a b c " * 30]
    for i in range(60):
        rows.append((i, " ".join([words(rng, rng.randrange(6), 8), rng.choice(parts), words(rng, rng.randrange(6), 8), rng.choice(parts)])))
    got = sorted(tuple(r) for r in substring.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(x[:4] for x in brute_repeats(rows))


def test_remove_repeats(odd):
    got = substring.remove_repeats(odd)
    assert got.schema == odd.schema
    want = [(d, kept if gone else text) for (d, n, gone, _, kept), text in
            zip(brute_repeats([(r.doc_id, r.text) for r in odd.collect()]), [r.text for r in odd.collect()]) if not gone or kept]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


# -- decontamination -----------------------------------------------------------------

def test_contamination(spark):
    rng = random.Random(4)
    item = [f"q{rng.randrange(500)}" for _ in range(30)]
    changed = list(item)
    for k in (5, 13, 22):
        changed[k] = "other"
    broken = [x if k % 3 else "no" for k, x in enumerate(item)]
    docs = [(1, f"{words(rng, 40)} {' '.join(item)} {words(rng, 20)}"), (2, f"{words(rng, 9)}, {' '.join(changed).upper()}!"),
            (3, words(rng, 200)), (4, " ".join(broken)), (5, " ".join(item[:20])), (6, None), (7, ""), (None, " ".join(item)), (1, "again")]
    bench = spark.createDataFrame([(10, " ".join(item), 0), (10, " ".join(item), 0), (11, None, 0), (12, "too short", 0), (None, words(rng, 30, 9000), 0)],
                                  "item_id long, text string, h int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start, r.n_tokens, r.n_agree) for r in spaced.contamination(df, bench).collect()}
    assert got == {(1, 10): (40, 30, 30), (2, 10): (9, 30, 27), (5, 10): (0, 20, 20), (None, 10): (0, 30, 30)}
    kept = spaced.decontaminate(df, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 7]
    assert spaced.contamination(df.limit(0), bench).count() == spaced.contamination(df, bench.limit(0)).count() == 0


def test_contamination_finds_whole_items(spark, small):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    def norm(t):
        return " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [(r.item_id, norm(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in small.collect() for i, t in items if t in norm(r.text)}
    assert want and {(r.doc_id, r.item_id) for r in spaced.contamination(small, bench).collect()} == want


def test_masks_meet_every_placement():
    for n, masks in spaced.MASKS.items():
        differ = n - -(-spaced.AGREE * n // 100)
        places = [{at + p for p in m} for m in masks for at in range(n - m[-1])]
        assert all(any(not p & set(bad) for p in places) for bad in combinations(range(n), differ)), n
    assert sorted(spaced.MASKS) == list(range(1, spaced.LEAST + 1))


def brute_contamination(docs, items):
    found = {}
    for d, text in docs:
        h = re.findall(r"[^\W_]+", text.lower())
        for i, item in items:
            q = item.split()
            wide = min(spaced.LEAST, len(q))
            for start in range(-len(q) + 1, len(h)):
                low, high = max(0, -start), min(len(q), len(h) - start)
                agree = [h[k + start] == q[k] for k in range(low, high)]
                most = max((sum(agree[k:k + wide]) for k in range(len(agree) - wide + 1)), default=-1)
                if 100 * most >= spaced.AGREE * wide:
                    found[d, i] = max(found.get((d, i), (0, -10**9, 0)), (sum(agree), -start, len(agree)))
    return {k: (-back, n, same) for k, (same, back, n) in found.items()}


def test_contamination_keeps_the_whole_rule(spark):
    """Items of every length, with substitutions on every 4th token and on
    random ones, cut at the text's ends, and in between other words."""
    rng = random.Random(14)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in (*range(1, 18), 40)]
    docs = []
    for n, item in items:
        for turn in range(24):
            q = item.split()
            for k in range(turn % 4, n, 4) if turn < 4 else rng.sample(range(n), min(n, rng.randrange(5))):
                q[k] = "other"
            q = q[rng.randrange(3):] if turn % 6 == 5 else q
            docs.append((len(docs), f"{words(rng, turn % 3)} {' '.join(q)} {words(rng, turn % 5)}"))
    want = brute_contamination(docs, items)
    got = spaced.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): (r.start, r.n_tokens, r.n_agree) for r in got.collect()} == want
    assert {i for _, i in want} == {i for i, _ in items}


def test_rows_without_an_id_are_judged_by_their_text(spark):
    rng = random.Random(6)
    item = words(rng, 20, 9000)
    docs = [(None, f"{words(rng, 9)} {item}"), (None, words(rng, 30)), (None, None), (None, ""), (7, item), (8, words(rng, 30))]
    docs += [(None, f"a{k} {item} b{k}") for k in range(400)] + [(None, f"c{k}") for k in range(400)]
    df = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, _text int, _bad int")
    bench = spark.createDataFrame([(None, item), (None, words(rng, 20, 9000)), (None, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_agree for r in spaced.contamination(df, bench).collect()}
    assert got == {(None, None): 20, (7, None): 20}
    kept = spaced.decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        ((d, t) for d, t in docs if not t or item not in t), key=str)


def test_long_overlaps_are_compared_in_linear_time(spark):
    long = " ".join(f"w{k % 977}x{k}" for k in range(60000))
    df = spark.createDataFrame([(1, long), (2, "w0x0 w1x1")], "doc_id long, text string")
    got = spaced.contamination(df, df.filter("doc_id = 1").withColumnRenamed("doc_id", "item_id")).collect()
    assert [(r.doc_id, r.start, r.n_agree) for r in got] == [(1, 0, 60000)]


def test_contamination_runs_no_python(spark, small):
    plan = spaced.contamination(small, spark.read.parquet(f"{SF}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- classifiers ----------------------------------------------------------------------

def test_language(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and np.mean([r.rejected for r in got]) < 0.01
    rows = langid.identify(odd).collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (4, 5, 6)} == {"und"}
    assert langid.identify(odd.limit(0)).count() == 0


def test_language_rejects_what_it_cannot_know(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    other = spark.createDataFrame([(9001, "Съешь же ещё этих мягких французских булок да выпей чаю. " * 5, None), (9002, "12345 67 !!", None)], docs.schema)
    kept = {r.doc_id for r in langid.keep_identified(docs.union(other)).collect()}
    assert not kept & {9001, 9002} and len(kept) >= 0.99 * docs.count()


def long_strangers():
    """Long texts of no language that the documents are labelled with."""
    rng=random.Random(21)
    L="abcdefghijklmnopqrstuvwxyz"
    it=("La mattina presto i pescatori tornano al porto con le reti piene e raccontano storie di tempeste lontane mentre le donne preparano il pane e i bambini "
        "corrono lungo la spiaggia. Nessuno ricorda quando fu costruita la vecchia torre, ma tutti sanno che ogni anno, alla fine dell'estate, qualcuno accende una luce sulla cima. ")
    pl=("Wczesnym rankiem rybacy wracają do portu z pełnymi sieciami i opowiadają historie o dalekich burzach, a kobiety przygotowują chleb i dzieci biegają wzdłuż plaży. "
        "Nikt nie pamięta, kiedy zbudowano starą wieżę, ale wszyscy wiedzą, że co roku pod koniec lata ktoś zapala światło na szczycie. ")
    ru="Рано утром рыбаки возвращаются в порт с полными сетями и рассказывают истории о далёких бурях. Никто не помнит, когда построили старую башню. "
    return {
        "letters":" ".join("".join(rng.choice(L) for _ in range(rng.randrange(2,10))) for _ in range(1000)),
        "chinese":"".join(chr(rng.randrange(0x4e00,0x9fa5)) for _ in range(3000)),
        "base64":base64.b64encode(rng.randbytes(6000)).decode(),"italian":it*4,"polish":pl*4,"russian":ru*20}


def test_language_rejects_long_texts_that_it_cannot_know(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    other = [(900_000 + k, t, None) for k, t in enumerate(long_strangers().values())]
    kept = {r.doc_id for r in langid.keep_identified(docs.union(spark.createDataFrame(other, docs.schema))).collect()}
    assert not kept & {r[0] for r in other} and len(kept) >= 0.99 * docs.count()


def test_language_threshold_sees_every_labelled_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", langid.F.col("doc_id").alias("key"))
    few, more = langid.fit(docs.filter("lang = 'en'"), 10), langid.fit(docs.filter("lang = 'en'"))
    assert np.array_equal(few["idf"], more["idf"])


def test_quality(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = qda.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.98
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    few = spark.createDataFrame([(1, 1), (3, 0), (9, 1), (None, 1), (7, None)], "doc_id long, quality int")
    assert qda.classify(odd, few).count() == odd.count()
    assert {r.score for r in qda.classify(odd, few.limit(0)).collect()} == {0.5}
    assert qda.classify(odd.limit(0), few).count() == 0


# -- rules ----------------------------------------------------------------------------

def test_rules(odd):
    rows = rules.quality_rules(odd).collect()
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows}
    want = set()
    for r in odd.collect():
        t, w = r.text or "", split(r.text)
        lines = [x for x in t.split("\n") if split(x)]
        seen = defaultdict(list)
        for k in range(len(w) - 2):
            seen[tuple(w[k:k + 3])].append(k)
        rep = {k + j for ks in seen.values() if len(ks) > 1 for k in ks for j in range(3)}
        want.add((r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep),
                  len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    assert got == want and not any(r.kept and r.base_failed for r in rows)
    led = rules.ledger(odd).cache()
    for r in rules.ablation(led).collect():
        bit = 1 << list(rules.RULES).index(r.rule)
        bits = [x.failed_rules for x in led.collect()]
        assert (r.n_failed, r.n_failed_alone, r.n_kept_without) == (
            sum(b & bit > 0 for b in bits), bits.count(bit), sum(b & ~bit == 0 for b in bits))


# -- mixing ---------------------------------------------------------------------------

def test_targets():
    got = mixing.targets([("b", 100), (None, 100), ("a", 1000), ("c", 100)])
    assert got == {"a": pytest.approx(1350.0), "b": 200.0, "c": pytest.approx(200.0), None: pytest.approx(200.0)}
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


def test_mixing(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix_sources(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(docs.repartition(5)).collect()))
    by = defaultdict(list)
    for r in rows:
        assert r.taken == r.copies * r.size and r.copies <= 2
        by[r.source].append(r)
    for own in by.values():
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    some = mixing.mix_sources(odd).collect()
    assert len(some) == odd.count() and all(r.size == 0 for r in some if r.doc_id in (4, 5, 6))
    assert mixing.mix_sources(odd.limit(0)).count() == 0


# -- WARC -----------------------------------------------------------------------------

def test_warc(spark, tmp_path):
    rng = random.Random(8)
    big = "<p>" + words(rng, 400) + "é\r\n\r\n</p>"
    rows = [(1, "u1", big), (2, "u\r\n2", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""),
            (None, "u", big), (3, "x", big)] + [(i, f"u{i}", f"<p>{i} {words(rng, 300)}") for i in range(20, 160)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, payload int")
    path = str(tmp_path / "warc")
    got = sorted((tuple(r) for r in warc.round_trip(pages, path).collect()), key=str)
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        again = len(p) >= 1000 and h == big and i is not None and i < 3
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want, key=str)
    back = {(r.page_id, bytes(r.payload)) for r in warc.read(spark, path).filter("record_type = 'response'").collect()}
    assert back == {(i, (h or "").encode()) for i, _, h in rows if not (h == big and i in (1, 2))}
    assert warc.round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0


# -- HTML -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def trees(spark):
    return dom.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_html_given_pages(spark, trees):
    import html
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    text = {r.page_id: r.text for r in dom.extract(pages, trees).collect()}
    wrong = 0
    for r in pages.collect():
        body = r.html.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body))
        wrong += text[r.page_id] != "\n".join(b for b in blocks if b)
    assert wrong <= 1


def test_html_other_layouts(trees):
    made, right = dom.Layouts(["river", "stone,", "and", "the", "old", "house.", "Grün"], seed=123), 0
    for _ in range(100):
        nodes = dom.parse(made.page())
        kept = dom.decode(nodes, dom.log_odds(trees, dom.features(nodes)))
        want = "\n".join(t for n in nodes if "data-kept" in n.attrs for t in n.order if not isinstance(t, dom.Node))
        right += dom.text_of(nodes, kept) == want
        assert all(kept[nodes.index(n.parent)] for n, k in zip(nodes, kept) if k and n.parent)
    assert right >= 85


def test_html_odd_cases(spark, trees):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<div><p>a<p>b"), (None, "u", "no markup"), (4, "u", "<" * 2000), (5, "u", "<p>" * 3000 + "x")]
    got = dom.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int"), trees).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (1, 2)} == {""}


def test_html_repeated_rows_long_pages_and_an_empty_table(spark, trees):
    schema = "page_id long, url string, html string"
    page = "<body><nav><a href=x>menu</a></nav><article>" + "<p>Some words of a long story, told at length.</p>" * 20000 + "</article></body>"
    got = dom.extract(spark.createDataFrame([(1, "u", page), (1, "u", page), (2, "u", "<p>a")], schema), trees).collect()
    assert sorted(r.page_id for r in got) == [1, 1, 2]
    assert len({r.text for r in got if r.page_id == 1}) == 1 and all(r.n_chars > 800000 for r in got if r.page_id == 1)
    assert dom.extract(spark.createDataFrame([], schema), trees).count() == 0


@pytest.mark.parametrize("page", [
    "<a " * 300000, "<a" * 400000, "<! " * 300000, "<a \"'" * 200000, '<a b="' * 160000, "<div>" * 60000 + "</section>" * 60000,
    "<span><div>" + "<b>" * 90000 + "</span>" * 90000, "<ul>" + "<b>" * 60000 + "<li>" * 60000, "<p><b>" * 80000,
    "<svg>" * 60000 + "<p>" * 60000, "<script>" * 100000, "<!--" * 200000], ids=lambda p: p[:12])
def test_html_broken_pages_take_linear_time(page):
    start = time.monotonic()
    assert dom.parse(page)
    assert time.monotonic() - start < 30


def test_html_tags_are_found_as_a_pattern_finds_them():
    """Against the definition as one pattern, which is quadratic."""
    tag = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
    rng = random.Random(12)
    for _ in range(4000):
        page = "".join(rng.choice(["<", ">", "<a ", "</b>", " x=", '"', "'", "<!", "<!--", "-->", "/", "t", "<?", "</"]) for _ in range(rng.randrange(40)))
        want = [(m.start(), m.end(), m[2] and m[2].lower()) for m in tag.finditer(page)]
        scan, got, at = dom.Scanner(page), [], 0
        while (found := scan.next(at)) is not None:
            got.append((found[0], found[1], found[3]))
            at = found[1]
        # the pattern may shorten a name that has a quote in it; the scanner never does
        if not re.search(r"<[a-zA-Z/][^\s/>]*[\"']", page):
            assert got == want, page


def test_html_elements_without_text_hide_nothing_else():
    page = ('<body><svg class="icon"/><p>a</p><svg><g><path d="x"/>no</svg><p>b</p><p><math/>c <select><option>no<option>no</select>d</p>'
            '<form><select><option>no<p>e</p></form><div><object>no<p>no</p></div><svg><text>no<p>f</p><object><ul><li>no<li>no</ul></object>'
            '<svg><foreignObject><div>no</div></foreignObject></svg><template><p>no</template><p>g')
    nodes = dom.parse(page)
    assert dom.text_of(nodes, [True] * len(nodes)).split() == list("abcdefg")
    nodes = dom.parse("<p>a</p><svg/><script>no<p>no</p></script><p>b")
    assert dom.text_of(nodes, [True] * len(nodes)).split() == ["a", "b"]


def test_html_features_do_not_change_with_size():
    alike = 2 * len(dom.TAGS) + 2 * len(dom.TOKENS) + 18
    for n in (20, 1999, 2500):
        nodes = dom.parse("<body><aside>a</aside>" + "<p>b</p>" * (n - 1))
        got = dom.features(nodes)[:, alike]
        assert got[2] == pytest.approx(1 / n) and got[3:] == pytest.approx((n - 1) / n)


# -- language model ---------------------------------------------------------------------

def test_lm_scores(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    shuffled = docs.limit(200).collect()
    rng = random.Random(0)
    made = []
    for r in shuffled:
        w = split(r.text)
        rng.shuffle(w)
        made.append((100_000 + r.doc_id, " ".join(w)))
    both = docs.union(spark.createDataFrame(made, docs.schema))
    got = {r.doc_id: r for r in pseudo.score(both).collect()}
    real = [got[r.doc_id].mean_log_prob - got[100_000 + r.doc_id].mean_log_prob for r in shuffled if got[r.doc_id].n_tokens > 50]
    assert np.mean(real) > 0                       # text in its order is likelier than the same words shuffled
    rows = pseudo.score(odd).collect()
    assert len(rows) == odd.count() and all((r.mean_log_prob is None) == (r.n_tokens == 0) and r.log_prob <= 0 for r in rows)
    assert pseudo.score(odd.limit(0)).count() == 0


def test_lm_class_shares_sum_to_one(spark, odd):
    vocab = pseudo.vocabulary(odd)
    counts = pseudo.word_counts(odd).collect()
    h = np.array([r.word for r in counts], dtype=np.int64).view(np.uint64)
    _, kind, share = pseudo.encode(h, vocab)
    for k in np.unique(kind):
        assert np.exp(share[kind == k]).sum() == pytest.approx(1, abs=1e-6)


def test_lm_takes_every_words_own_count(spark, odd, monkeypatch):
    few = odd.filter("doc_id < 14").coalesce(1)
    assert pseudo.word_counts(few).count() > 2 * pseudo.OWN_ROWS
    whole = pseudo.score(few).collect()
    monkeypatch.setattr(pseudo, "KNOWN", pseudo.OWN_ROWS)
    got = pseudo.score(few).collect()
    for rows in (whole, got):
        rows.sort(key=lambda r: (r.doc_id, r.log_prob))
    assert [(r.doc_id, r.n_tokens) for r in got] == [(r.doc_id, r.n_tokens) for r in whole]
    assert [r.log_prob for r in got] == pytest.approx([r.log_prob for r in whole], rel=1e-5)


def test_lm_trains_on_every_document(spark, odd):
    start = pseudo.Network().flat()
    for k in range(1, 7):
        one = spark.createDataFrame([(k, f"a b c {k}")], "doc_id long, text string")
        assert not np.array_equal(pseudo.train(one, pseudo.vocabulary(one)), start)


# -- large groups, null ids ----------------------------------------------------------

def test_near_duplicates_in_large_groups(spark):
    """Hundreds of copies of two texts that are just not similar, texts between
    the two, and texts under the threshold to all: several blocks a bucket."""
    rng = random.Random(11)
    base = words(rng, 150, 3000).split()
    other = list(base)
    for k in range(0, 150, 30):
        other[k] = f"other{k}"

    def changed(text, n):
        text = list(text)
        for k in rng.sample(range(len(text)), n):
            text[k] = f"new{rng.randrange(10 ** 6)}"
        return " ".join(text)
    rows = [(None if i % 40 == 7 else i, changed(base if i % 2 else other, 1)) for i in range(240)]
    rows += [(1000 + i, changed(base, 6)) for i in range(60)] + [(2000 + i, changed(base, 2)) for i in range(30)]
    rng.shuffle(rows)
    for percent in (85, 80):
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows, percent)


def test_dropping_goes_by_id_and_text(spark):
    rng = random.Random(4)
    a, b = words(rng, 100), words(rng, 100)
    rows = [(1, a, "x"), (None, a, "x"), (None, b, "y"), (None, None, "n"), (5, None, None), (2, b + " tail", "z"), (2, a, "w"), (1, a, "x")]
    rows += [(None, words(rng, 30), "many") for _ in range(300)]
    got = minhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, seen string")).collect()
    # a's group keeps id 1 (both rows), b's group keeps id 2, other texts without id stay
    assert sorted((r.doc_id, r.seen) for r in got if r.seen and r.doc_id) == [(1, "x"), (1, "x"), (2, "z")]
    assert sorted(r.seen for r in got if r.doc_id is None) == ["many"] * 300 + ["n"]
    assert [r.seen for r in got if r.doc_id == 5] == [None]


def test_maybe_in_lets_all_wanted_through(spark):
    from pyspark.sql import functions as F

    from gridlake.llm.common import maybe_in
    rows = spark.range(50_000).select(F.xxhash64("id").alias("k"), "id", F.lit(1).alias("_place"))
    wanted = rows.filter("id % 50 = 0").select("k")
    got = maybe_in(rows, "k", wanted, 1000).filter("_maybe")
    assert got.columns == ["k", "id", "_place", "_maybe"]
    assert got.filter("id % 50 = 0").count() == 1000 and got.count() < 8000
    assert maybe_in(rows, "k", wanted.filter("false"), 0).filter("_maybe").count() == 0


def test_a_task_gives_back_what_it_has_freed():
    from gridlake.llm.common import released
    ended = []

    def run(batches):
        try:
            yield from batches
        finally:
            ended.append(True)
    assert list(released(run)(iter([1, 2]))) == [1, 2] and ended == [True]
    some = released(run)(iter([1, 2]))          # a task that is stopped early
    assert next(some) == 1
    some.close()
    assert ended == [True, True]
