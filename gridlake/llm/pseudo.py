"""Language-model scores by masked pseudo-likelihood.

A small network predicts every token of a text from its neighbours on both
sides: the two words before and the two after select rows of four input
tables, whose sum goes through tanh into a softmax over classes of words. A
word's probability is that of its class times its share of the class, taken
from the counts of all words of all documents. A text's score is the sum of
its tokens' conditional log-probabilities.

The word counts cover the whole corpus, and each word's own count makes its
share: tasks hold those of the ``KNOWN`` most frequent words, and all others
are joined from the stored counts, once for each word of a document. The
network is trained in numpy where the documents are: every document is in one
of ``ROUNDS`` rounds, by hash; in each of them every task runs AdaGrad over its
documents, starting from the same weights, and the tasks' weights are averaged
by tokens in Spark. What is counted and trained on grows with the corpus; what
reaches the driver is the model, of fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, lists, longs, map_texts, slices, store

SIDE = 2
HIDDEN = 24
#: words with an input row of their own, and rows that the others share by hash
OWN_ROWS, SHARED_ROWS = 768, 256
#: words that are a class of their own, and classes that the others share by hash
OWN_CLASSES, SHARED_CLASSES = 48, 16
#: words whose counts every task holds; the others' are joined
KNOWN = 4096
#: parts of the documents, each trained on in a round of its own
ROUNDS = 2
BATCH, STEP = 4096, 0.05
#: words that a task counts before it hands the counts on
HELD_WORDS = 1 << 20
_PARTS = 64


def word_counts(documents: DataFrame) -> DataFrame:
    """(word hash, n) over all texts."""
    def run(batches):
        names, counts, size = [], [], 0

        def flush():
            nonlocal names, counts, size
            if not names:
                return None
            name = np.concatenate(names)
            u, back = np.unique(name, return_inverse=True)
            n = np.bincount(back, np.concatenate(counts), len(u)).astype(np.int64)
            names, counts, size = [], [], 0
            return u, n

        for batch in batches:
            for _, _, texts in slices(batch.column("text")):
                u, n = np.unique(texts.hashes(), return_counts=True)
                names.append(u)
                counts.append(n)
                size += len(u)
                if size > HELD_WORDS:
                    u, n = flush()
                    if len(u) > HELD_WORDS // 2:
                        yield pa.RecordBatch.from_pydict({"word": longs(u), "n": longs(n)})
                    else:
                        names, counts, size = [u], [n], len(u)
        last = flush()
        if last:
            yield pa.RecordBatch.from_pydict({"word": longs(last[0]), "n": longs(last[1])})

    return documents.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(documents: DataFrame, counts: DataFrame | None = None) -> dict:
    """The ``KNOWN`` most frequent words, their classes and shares of them, and
    the share that a count of one has of each class. ``counts`` are the stored
    word counts of the documents."""
    counts = store(word_counts(documents), "words") if counts is None else counts
    top = [(r.word, r.n) for r in counts.orderBy(F.desc("n"), "word").limit(KNOWN).collect()]
    word = np.array([w for w, _ in top], dtype=np.int64).view(np.uint64)
    n = np.array([c for _, c in top], dtype=np.float64)
    # the classes' sums, of all words, are taken where the counts are
    own = [int(w) for w, _ in top[:OWN_CLASSES]]
    shared = counts.filter(~F.col("word").isin(own)) if own else counts
    rest = {r["class"]: r.n for r in shared.groupBy(_shared_class().alias("class")).agg(F.sum("n").alias("n")).collect()}
    kind = OWN_CLASSES + (word >> np.uint64(32)).astype(np.int64) % SHARED_CLASSES
    kind[:OWN_CLASSES] = np.arange(len(kind[:OWN_CLASSES]))
    total = np.zeros(OWN_CLASSES + SHARED_CLASSES)
    for c, m in rest.items():
        total[c] = m
    share = np.zeros(len(word))
    share[OWN_CLASSES:] = np.log(n[OWN_CLASSES:]) - np.log(total[kind[OWN_CLASSES:]])
    one = -np.log(np.maximum(total, 1))
    order = np.argsort(word)
    return {"word": word[order], "rank": order, "kind": kind[order], "share": share[order], "one": one}


def _shared_class():
    return (F.lit(OWN_CLASSES) + F.shiftrightunsigned("word", 32) % SHARED_CLASSES).cast("int")


def lookup(h: np.ndarray, vocab: dict) -> tuple[np.ndarray, np.ndarray]:
    """Each word's place among the known words, and whether it is one."""
    if not len(vocab["word"]):
        return np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=bool)
    at = np.minimum(np.searchsorted(vocab["word"], h), len(vocab["word"]) - 1)
    return at, vocab["word"][at] == h


def encode(h: np.ndarray, vocab: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input row, class and log share of its class, of each word. The log of
    its count is still to be added to the share of a word that is not known."""
    row = OWN_ROWS + ((h >> np.uint64(16)) % np.uint64(SHARED_ROWS)).astype(np.int64)
    kind = OWN_CLASSES + (h >> np.uint64(32)).astype(np.int64) % SHARED_CLASSES
    share = vocab["one"][kind]
    at, hit = lookup(h, vocab)
    if hit.any():
        rank = vocab["rank"][at]
        row = np.where(hit & (rank < OWN_ROWS), rank, row)
        kind = np.where(hit, vocab["kind"][at], kind)
        share = np.where(hit, vocab["share"][at], share)
    return row, kind, share


def others(h: np.ndarray, doc: np.ndarray, n: int, vocab: dict) -> pa.Array:
    """For each of n texts, its words that are not known and how often it has them."""
    left = np.flatnonzero(~lookup(h, vocab)[1])
    left = left[np.lexsort((h[left], doc[left]))]
    word, of = h[left], doc[left]
    head = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (of[1:] != of[:-1])])) if len(left) else left
    times = np.diff(np.append(head, len(left)))
    pairs = pa.StructArray.from_arrays([longs(word[head]), longs(times)], ["word", "times"])
    return lists(pairs, np.bincount(of[head], minlength=n))


def neighbours(row: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The input rows of the words at -SIDE .. -1, 1 .. SIDE; the last row of
    a table stands for the text's outside."""
    out = np.full((len(row), 2 * SIDE), OWN_ROWS + SHARED_ROWS, dtype=np.int16)
    for k, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        a, b = (slice(-d, None), slice(None, d)) if d < 0 else (slice(None, -d), slice(d, None))
        same = doc[a] == doc[b]
        out[a, k] = np.where(same, row[b], OWN_ROWS + SHARED_ROWS)
    return out


class Network:
    """tables (2 SIDE x rows x HIDDEN), bias, out (HIDDEN x classes), base."""

    def __init__(self, flat: np.ndarray | None = None):
        rows, classes = OWN_ROWS + SHARED_ROWS + 1, OWN_CLASSES + SHARED_CLASSES
        shapes = [(2 * SIDE, rows, HIDDEN), (HIDDEN,), (HIDDEN, classes), (classes,)]
        if flat is None:
            rng = np.random.default_rng(11)
            self.all = [(rng.standard_normal(s) * (0.1 if len(s) > 1 else 0)).astype(np.float32) for s in shapes]
        else:
            cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
            self.all = [x.reshape(s).copy() for x, s in zip(np.split(flat.astype(np.float32), cuts), shapes)]
        self.square = [np.full(x.shape[:2] if x.ndim == 3 else x.shape, 1e-2, dtype=np.float32) for x in self.all]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.all])

    def forward(self, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tables, bias, out, base = self.all
        x = tables[0][near[:, 0]] + bias
        for k in range(1, near.shape[1]):
            x += tables[k][near[:, k]]
        np.tanh(x, out=x)
        z = x @ out + base
        z -= z.max(1, keepdims=True)
        return x, z

    def learn(self, near: np.ndarray, kind: np.ndarray) -> None:
        tables, bias, out, base = self.all
        s_tables, s_bias, s_out, s_base = self.square
        x, z = self.forward(near)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(kind)), kind] -= 1
        dx = (p @ out.T) * (1 - x * x)
        for w, s, g in ((out, s_out, x.T @ p / len(kind)), (base, s_base, p.mean(0)), (bias, s_bias, dx.mean(0))):
            s += g * g
            w -= STEP * g / np.sqrt(s)
        dx /= len(kind)
        for k in range(near.shape[1]):
            order = np.argsort(near[:, k], kind="stable")
            own = near[order, k]
            head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            g = np.add.reduceat(dx[order], head)
            u = own[head]
            s_tables[k, u] += (g * g).sum(1)
            tables[k, u] -= STEP * g / np.sqrt(s_tables[k, u])[:, None]


def train(documents: DataFrame, vocab: dict) -> np.ndarray:
    """The weights, flat."""
    weights = Network().flat()
    for turn in range(ROUNDS):
        part = F.pmod(F.xxhash64(F.lit("lm"), "doc_id", "text"), F.lit(ROUNDS)) == turn

        def run(batches, start=weights):
            net, seen, held = Network(start), 0, []
            for batch in batches:
                for _, _, texts in slices(batch.column("text")):
                    row, kind, _ = encode(texts.hashes(), vocab)
                    near = neighbours(row, texts.doc())
                    order = np.random.default_rng(len(row)).permutation(len(row))
                    for a in range(0, len(order), BATCH):
                        i = order[a:a + BATCH]
                        net.learn(near[i], kind[i])
                    seen += len(row)
            if seen:
                parts = np.array_split(net.flat().astype(np.float64) * seen, _PARTS)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(range(_PARTS), type=pa.int32()), "seen": pa.array([float(seen)] * _PARTS),
                    "w": pa.array([p.tobytes() for p in parts], type=pa.binary())})

        def mean(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(w.as_buffer()) for w in group.column("w"))
            seen = sum(x.as_py() for x in group.column("seen"))
            return pa.table({"part": group.column("part").slice(0, 1), "w": pa.array([(total / seen).tobytes()], type=pa.binary())})

        got = documents.filter(part).select("text").mapInArrow(run, "part int, seen double, w binary").groupBy("part").applyInArrow(
            mean, "part int, w binary").collect()
        if got:
            weights = np.concatenate([np.frombuffer(r.w) for r in sorted(got, key=lambda r: r.part)])
    return weights.astype(np.float32)


def score(documents: DataFrame) -> DataFrame:
    """doc_id, n_tokens, log_prob (natural logarithm, summed over the tokens)
    and mean_log_prob of each row of ``documents (doc_id, text)``, under a
    network trained on them.

    * null or empty text: n_tokens 0, log_prob 0, mean_log_prob null;
    * null doc_id: scored like any other; repeated rows: each is scored and
      counted; a one-word text is predicted from its outside alone;
    * extra columns are not read; an empty table gives an empty result.
    """
    documents = documents.select("doc_id", "text")
    counts = store(word_counts(documents), "words")
    vocab = vocabulary(documents, counts)
    weights = train(documents, vocab)

    def run(rows: pa.RecordBatch, texts: Texts) -> dict:
        net, h = Network(weights), texts.hashes()
        row, kind, share = encode(h, vocab)
        doc = texts.doc()
        near = neighbours(row, doc)
        log = np.zeros(len(row))
        for a in range(0, len(row), BATCH):
            _, z = net.forward(near[a:a + BATCH])
            own = z[np.arange(len(z)), kind[a:a + BATCH]]
            log[a:a + BATCH] = own - np.log(np.exp(z).sum(1)) + share[a:a + BATCH]
        return {"row": rows.column("row"), "doc_id": rows.column("doc_id").cast(pa.int64()), "n_tokens": longs(np.diff(texts.first)),
                "log": pa.array(np.bincount(doc, log, len(texts))), "others": others(h, doc, len(texts), vocab)}

    # stored, so that a row keeps its number
    judged = store(map_texts(documents.withColumn("row", F.monotonically_increasing_id()), run,
                             "row long, doc_id long, n_tokens long, log double, others array<struct<word:long,times:long>>"), "judged")
    held = judged.select("row", F.inline("others")).join(counts, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log("n")).alias("more"))
    total = F.col("log") + F.coalesce("more", F.lit(0.0))
    return judged.drop("others").join(held, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_prob"), F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_prob"))
