"""Whitening, fill-in-the-middle and packing against brute force, and the odd
cases: nulls, empty and long inputs, ties, repeated rows, empty tables, extra
columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from gridlake.llm import infill, packing, whiten
from gridlake.llm.queries import queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n long, ids string, part int"


# -- whitening ---------------------------------------------------------------------

def brute_whitening(rows, k=4):
    good = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in good}), dtype=object)
    n, s = len(x), x.sum(0)
    mean = np.array([a / n for a in s], dtype=float)
    c = x.astype(float) - mean
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for i, row in good:
        dev = sum((n * a - b) ** 2 for a, b in zip(row, s))
        w = (np.array(row, dtype=float) - mean) @ u / np.sqrt(e)
        for j in range(k):
            out.setdefault((i, j + 1), []).append((n, int(dev), w[j], e[j] / np.trace(v)))
    return out


def compare_whitening(got, want):
    assert sorted((r.vec_id, r.component) for r in got) == sorted(k for k, v in want.items() for _ in v)
    for r in got:
        n, dev, w, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, dev)
        assert abs(abs(r.whitened) - abs(w)) < 1e-8 and abs(r.explained - explained) < 1e-10
        assert r.identity_error < 1e-9


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare_whitening(queries()["op11_whitening"](spark, SF).collect(), brute_whitening(rows))


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(40, 6)) * [9, 7, 4, 2, 1, .5] + 1000).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(0, base[0]), (100, base[0])]
    odd = [(101, None), (102, [1.0] * 5 + [None]), (103, [float("nan")] + [0.0] * 5), (104, [float("inf")] + [0.0] * 5), (105, []), (106, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "z") for i, v in rows + odd], "vec_id long, embedding array<double>, x int, n string")
    compare_whitening(whiten.whiten(df).collect(), brute_whitening(rows))
    a, b = (sorted(map(tuple, whiten.whiten(d).select("vec_id", "component", "n", "deviation").collect())) for d in (df, df.repartition(7, "vec_id")))
    assert a == b


def test_whitening_without_variance(spark):
    def table(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whiten.whiten(table([])).collect() == []
    assert whiten.whiten(table([(1, None), (2, [])])).collect() == []
    assert whiten.whiten(table([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    got = whiten.whiten(table([(None, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 3.0])])).collect()
    assert sorted((r.vec_id is None, r.component, round(abs(r.whitened), 9), round(r.explained, 12)) for r in got) == [(False, 1, 1.0, 1.0), (True, 1, 1.0, 1.0)]
    got = whiten.whiten(table([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])])).collect()
    assert all(r.deviation is None and np.isfinite(r.whitened) for r in got if r.vec_id != 3)


def test_factor_and_rotations_are_accurate():
    rng = np.random.default_rng(1)
    for d, r in ((1, 1), (5, 5), (30, 12), (64, 64)):
        m = rng.normal(size=(d, r)) * 10.0 ** rng.uniform(-3, 3, r)
        a = m @ m.T
        f = whiten.pivoted_cholesky(a)
        assert f.shape[1] <= d and np.allclose(f @ f.T, a, atol=1e-12 * a.max())
        values, vectors = whiten.principal(a)
        assert np.allclose(vectors @ vectors.T, np.eye(len(vectors)), atol=1e-12)
        assert np.allclose(values[:r], np.linalg.eigvalsh(a)[::-1][:len(values)][:r], rtol=1e-8, atol=1e-12 * a.max())
        assert np.abs(vectors[0] @ a - values[0] * vectors[0]).max() < 1e-13 * values[0] * d


# -- fill in the middle ---------------------------------------------------------------

def odd_texts():
    rng = random.Random(2)
    letters = "abc é ß 数据 😀 <PSM> "
    return [(1, "plain ascii text"), (2, None), (3, ""), (4, "has <S> a mark"), (5, "é"), (None, "no id 😀 here"), (None, None),
            (6, "".join(rng.choice(letters) for _ in range(300_000))), (7, "x" * 50_000 + "数" * 50_000 + "é" * 7), (1, "other text of id 1"),
            (1, "other text of id 1"), (8, "<" * 40 + "P" + "<S<M" * 30)] + [
        (100 + i, "".join(rng.choice(letters) for _ in range(i)).replace("<P>", "")) for i in range(300)]


def brute_infill(i, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return i, len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return i, len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_infill_equals_brute_force(spark):
    rows = odd_texts()
    df = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], DOCS)
    got = infill.fill_in_middle(df).select("*", infill.restored().alias("restored")).collect()
    assert sorted(map(str, [tuple(r)[:-1] for r in got])) == sorted(map(str, [brute_infill(*r) for r in rows]))
    assert sorted(r.restored for r in got) == sorted(t or "" for _, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(df.filter("false")).collect() == []


@pytest.mark.parametrize("widths", [[1] * 5000, [1, 3] * 5000, [4] * 100 + [1] * 90000 + [3] * 9000, [], [2]])
def test_rank_index_is_exact_and_bounded(widths):
    offsets = np.concatenate([[0], np.cumsum(np.array(widths, dtype=np.int64))]).astype(np.int64)
    index = infill.RankIndex(offsets)
    assert (index.offset(np.arange(len(offsets))) == offsets).all()
    assert np.abs(index.residual.astype(int)).max() <= infill.ERROR + 1


def test_rank_index_needs_few_segments():
    widths = np.random.default_rng(0).choice([1, 2, 3, 4], size=200_000, p=[.9, .05, .04, .01])
    index = infill.RankIndex(np.concatenate([[0], np.cumsum(widths)]))
    assert len(index.first) < 60


# -- packing ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe():
    public = pytest.importorskip("public_tokenizers")
    return str(public.path("byte_bpe_50k.json"))


def check_pieces(pieces, rows, bpe, width):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe)
    want = sorted([(i is None, i or 0, [*t.encode(x or "", add_special_tokens=False).ids, 0]) for i, x in rows])
    total = sum(len(w[2]) for w in want)
    places = sorted((p.sequence_id * width + p.offset, p.length) for p in pieces)
    assert [p for p, _ in places] == [0, *np.cumsum([n for _, n in places]).tolist()[:-1]] and sum(n for _, n in places) == total
    assert all(0 < p.length and p.offset + p.length <= width for p in pieces)
    ordered = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    got, own = [], []
    for p in ordered:            # a document's pieces are neighbours
        ids = np.frombuffer(bytes(p.ids), dtype="<u4").tolist()
        assert len(ids) == p.length and p.start == len(own)
        own += ids
        if len(own) == p.doc_tokens:
            got.append((p.doc_id is None, p.doc_id or 0, own))
            own = []
    assert not own and sorted(got) == want


def test_pieces_equal_brute_force(spark, bpe):
    rows = [(i, x) for i, x in odd_texts() if len(x or "") < 60_000] + [(900 + i, f"word {i} " * (i * 7)) for i in range(80)]
    df = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], DOCS).repartition(5)
    for width in (1024, 16):
        check_pieces(packing.pack(df, bpe, width).collect(), rows, bpe, width)
    assert packing.pack(df.filter("false"), bpe).collect() == []
    assert packing.sequences(packing.pack(df.filter("false"), bpe)).collect() == []


def test_chunks_give_the_ids_of_whole_texts(bpe):
    import pyarrow as pa

    from gridlake.llm.common import slices
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u180e", "\ufeff", "word", "Wort's", "don't",
             "12", "数据", "é", "!?", "'", "😀", "<|endoftext|>", "\x00", "а", "_"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)] + [" ", "", "x", "\n\n"]
    t = packing._tokenizer(bpe)
    assert packing.cuts_by_kind(t)
    for size in (packing._MEMO, 50):
        packing._memo[:] = [{}, {}]
        packing._MEMO, kept = size, packing._MEMO
        for a, b, texts in slices(pa.array(rows)):
            ids, n = packing._by_chunks(t, texts)
            want, m = packing._whole(t, texts)
            assert n.tolist() == m.tolist() and ids.tolist() == want.tolist()
        packing._MEMO = kept


def test_ascii_words_go_to_the_model_at_once(bpe, monkeypatch):
    """The rest of the tokenizer sees the other chunks alone, and the ids are equal."""
    rng = random.Random(4)
    words = sorted({(rng.choice(["", " "]) + "".join(rng.choice("abcdeghIOU") for _ in range(rng.randrange(1, 14)))).encode() for _ in range(400)})
    others = [b"", b" ", b"  a", b"\n", b"\nab", b"ab,", b" 12", " \u00e9t\u00e9".encode(), b"a b", b" don't", b"\tx"]
    t, marked, seen = packing._tokenizer(bpe), packing._marked, []
    chunks = [c for pair in zip(words, others * len(words)) for c in pair]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]
    monkeypatch.setattr(packing, "_marked", lambda tokenizer, some: (seen.extend(some), marked(tokenizer, some))[1])
    assert packing._encoded(t, chunks) == want
    assert set(seen) == set(others)


def texts_of(rows):
    """Texts of any bytes."""
    from gridlake.llm.common import Texts
    return Texts(np.frombuffer(b"".join(rows), dtype=np.uint8), np.cumsum([0, *map(len, rows)]))


def test_words_of_any_letters_are_tokenised_once(bpe, monkeypatch):
    """Words of known letters are chunks, whatever stands beside them, and go to the model at once."""
    rng = random.Random(11)
    words = ["\u00fcber", "Stra\u00dfe", "ni\u00f1o", "\u00e9t\u00e9", "\u0441\u043b\u043e\u0432\u043e", "\u03bb\u03cc\u03b3\u03bf\u03c2", "\u6570\u636e", "plain", "12"]
    rows = [(rng.choice(["", "\n", "\u201c"]) + rng.choice([" ", "\n", " \u2014 "]).join(rng.choices(words, k=12))).encode() for _ in range(200)]
    t, encoded, seen = packing._tokenizer(bpe), packing._encoded, []
    monkeypatch.setattr(packing, "_memo", [{}, {}])
    monkeypatch.setattr(packing, "_encoded", lambda tokenizer, chunks, *a: (seen.extend(chunks), encoded(tokenizer, chunks, *a))[1])
    monkeypatch.setattr(packing, "_marked", lambda tokenizer, chunks: pytest.fail(f"not sent to the model: {chunks}"))
    for half in (rows[:100], rows[100:]):
        ids, n = packing._by_chunks(t, texts_of(half))
        want, m = packing._whole(t, texts_of(half))
        assert n.tolist() == m.tolist() and ids.tolist() == want.tolist()
    assert len(seen) == len(set(seen)) <= 2 * len(words) + 4


def test_kinds_are_those_of_the_tokenizer(bpe):
    """Every character of a kind is cut from other kinds, and from no own one, as the tokenizer does."""
    cut = packing._tokenizer(bpe).pre_tokenizer.pre_tokenize_str
    for kind, others in ((1, "1 !"), (2, "a !"), (3, "a 1")):
        known = np.flatnonzero(packing._KIND == kind)
        signs = "".join(chr(c) for c in known if c != 39)
        assert len(cut(signs)) == 1
        for other in others:
            pieces = cut("".join(c + other for c in signs) + signs[:1])
            assert len(pieces) == len(signs) + 1 if other == " " else len(pieces) == 2 * len(signs) + 1
    assert (packing._KIND > 0).sum() > 30_000 and not packing._KIND[[0x85, 0xA0, 0x0301, 0x2003, 0x2028, 0x3000, 0xD800, 0xFFFF]].any()


def test_odd_signs_give_the_ids_of_whole_texts(bpe, monkeypatch):
    rng = random.Random(21)
    parts = [x.encode() for x in (
        " ", "  ", "\n", "\n\n", "\r\n", "\t", " \n", "\n ", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\u180e", "\u200b", "\u0301", "e\u0301", "\u00fc",
        "\u00df", "\u0441\u043b", "\u6570", "\u3002", "\u201c", "\u2014", "\u00bd", "\u0663", "\u20ac", "'", "\u2019", "'s", "'ve", "'\u00e9", "ab", "I", "7", "!", "\U0001f600", "\U00020000", "\ue000")]
    parts += [b"\xc3", b"\xa9", b"\xe2\x80", b"\xe0\x80\x80", b"\xed\xa0\x80", b"\xff", b"\xf0\x9f"]        # no UTF-8
    t = packing._tokenizer(bpe)
    monkeypatch.setattr(packing, "_memo", [{}, {}])
    for whole in (len(parts) - 7, len(parts)):
        for size in (500, 50):
            monkeypatch.setattr(packing, "_MEMO", size)
            for _ in range(6):
                texts = texts_of([b"".join(rng.choices(parts[:whole], k=rng.randrange(9))) for _ in range(1500)])
                ids, n = packing._by_chunks(t, texts)
                want, m = packing._whole(t, texts)
                assert n.tolist() == m.tolist() and ids.tolist() == want.tolist()


def test_memo_tells_chunks_of_equal_names_apart(bpe, monkeypatch):
    from gridlake.llm.common import Texts
    t = packing._tokenizer(bpe)
    monkeypatch.setattr(packing, "_memo", [{}, {}])
    monkeypatch.setattr(Texts, "span_hashes", lambda self, start, end: np.arange(len(start), dtype=np.uint64))
    for rows in ([b"one two"], [b"six two"], [b"one ten"], [b"a", b"longer"], [b"one two"]):
        ids, n = packing._by_chunks(t, texts_of(rows))
        want, m = packing._whole(t, texts_of(rows))
        assert n.tolist() == m.tolist() and ids.tolist() == want.tolist()


def test_memo_stays_small(bpe, monkeypatch):
    """No Python object for each chunk, and no long chunks."""
    t = packing._tokenizer(bpe)
    monkeypatch.setattr(packing, "_memo", [{}, {}])
    packing._by_chunks(t, texts_of([b" ".join(b"word" + bytes([97 + i // 676, 97 + i // 26 % 26, 97 + i % 26]) for i in range(9000)), b"x" * 100_000]))
    held = packing._memo[0]
    assert len(held["name"]) >= 9000 and sum(x.nbytes for x in held.values()) < 80 * len(held["name"])


def test_sequences_hold_all_pieces(spark, bpe):
    rows = [(i, f"some words of text {i} " * (i % 60)) for i in range(300)]
    pieces = packing.store(packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), bpe, 256), "t-pieces")
    got = packing.sequences(pieces, 256).orderBy("sequence_id").collect()
    assert [s.sequence_id for s in got] == list(range(len(got))) and all(s.n_ids == 256 for s in got[:-1])
    by = {}
    for p in sorted(pieces.collect(), key=lambda p: (p.sequence_id, p.offset)):
        by.setdefault(p.sequence_id, []).append(p)
    for s in got:
        assert bytes(s.ids) == b"".join(bytes(p.ids) for p in by[s.sequence_id])
        assert s.starts == [p.offset for p in by[s.sequence_id]] and s.doc_ids == [p.doc_id for p in by[s.sequence_id]]
        assert s.padded == (s.n_ids if s.n_ids & (s.n_ids - 1) == 0 else 256)


def test_packing_query(spark, bpe):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries()["op13_packing"](spark, SF).collect()
    want = {(p.doc_id, p.start, p.length, zlib.crc32(bytes(p.ids))) for p in packing.pack(docs, bpe).collect()}
    assert {(p.doc_id, p.start, p.length, p.ids_crc32) for p in got} == want


def test_neighbours_are_numbers_that_sort_by_digits():
    """numpy sorts numbers of up to 16 bits stably in linear time; training sorts each batch."""
    import numpy as np

    from gridlake.llm import pseudo
    near = pseudo.neighbours(np.array([5, 6, 7, 1023]), np.array([0, 0, 0, 1]))
    out = pseudo.OWN_ROWS + pseudo.SHARED_ROWS
    assert near.dtype == np.int16 and out < 1 << 15
    assert near.tolist() == [[out, out, 6, 7], [out, 5, 7, out], [5, 6, out, out], [out] * 4]


def test_centroids_take_no_second_copy_of_the_texts():
    """The driver holds one language's vectors once, with next to nothing beside them."""
    import tracemalloc

    import numpy as np

    from gridlake.llm import langid
    v = np.random.default_rng(1).random((400, langid.DIMS), dtype=np.float32)
    v /= np.sqrt((v * v).sum(1, keepdims=True))
    tracemalloc.start()
    centres = langid._k_means(v, 1, rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    m = v.mean(0)
    assert (centres[0] == m / np.sqrt(m @ m)).all()
    assert peak < v.nbytes / 4
