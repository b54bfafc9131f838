"""Language identification by nearest centroid.

A text is the L2-normalised TF-IDF vector of its character trigrams (letters
lower-cased, anything else a single blank) hashed to ``DIMS`` places. Each
language has up to ``CENTROIDS`` centroids from spherical k-means over a
bounded sample of labelled texts; document frequencies and rejection thresholds
are taken from all of them. A text belongs to the language of the centroid with
the highest cosine, and is rejected if that cosine is lower than nearly all
cosines of the language's training texts (for a text under ``FULL`` letters, in
proportion to the root of its length, as its cosine is).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _P, Texts, give_back, held_out, map_texts, mix, released

DIMS = 1 << 14
CENTROIDS = 4
#: Labelled texts of each language that centroids are made of, at most.
SAMPLE = 1500
#: A text is rejected under this fraction of the cosine that all but
#: ``LOW`` of its language's training texts reach.
REJECT, LOW = 0.75, 0.005
#: steps in which the training texts' cosines are counted
STEPS = 1000
FULL = 100


def _grams(low: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and count of the hashed trigrams, by text and place, and the
    number of letters of each text."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in low]
    size = np.array([len(p) for p in points], dtype=np.int64)
    flat = np.concatenate(points) if points else np.zeros(0, dtype=np.uint32)
    letter = _letters(flat)
    doc = np.repeat(np.arange(len(low)), size)
    letters = np.bincount(doc[letter], minlength=len(low))
    c = np.where(letter, flat, 32).astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), letters
    value = (c[:-2] * np.uint64(0x1000003) ^ c[1:-1]) * np.uint64(0x1000003) ^ c[2:]
    ok = (doc[:-2] == doc[2:]) & (letter[:-2] | letter[1:-1] | letter[2:])
    at = ((mix(value[ok] * np.uint64(_P)) % np.uint64(DIMS)).astype(np.int64)) + doc[:-2][ok] * DIMS
    counts = np.bincount(at, minlength=len(low) * DIMS)
    at = np.flatnonzero(counts)
    return at // DIMS, at % DIMS, counts[at].astype(np.float32), letters


_is_letter: list[np.ndarray] = []


def _letters(points: np.ndarray) -> np.ndarray:
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _is_letter[0][points]


def _weigh(doc: np.ndarray, place: np.ndarray, counts: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """The weight of each trigram in its text's vector, of n texts."""
    v = np.log1p(counts) * idf[place]
    norm = np.sqrt(np.bincount(doc, v * v, n)).astype(np.float32)
    return v / np.where(norm == 0, 1, norm)[doc]


#: trigrams x centres that are multiplied at once, about
_PRODUCTS = 1 << 20


def _cosines(doc: np.ndarray, place: np.ndarray, v: np.ndarray, n: int, across: np.ndarray) -> np.ndarray:
    """Texts x centres, of which ``across`` has the places in its rows."""
    out = np.zeros((n, across.shape[1]), dtype=np.float32)
    if len(doc):
        head = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        step = max(1, _PRODUCTS // len(doc))
        for a in range(0, across.shape[1], step):
            m = across[place, a:a + step]
            m *= v[:, None]
            out[doc[head], a:a + step] = np.add.reduceat(m, head)
    return out


def _texts(column: pa.Array, step: int = 32, most: int = 1 << 17):
    """Lower-cased texts, a few at a time: about ``most`` characters, for a
    task's memory is some hundred bytes for each of them."""
    for a in range(0, len(column), step):
        part, size = [], 0
        for t in column.slice(a, step).to_pylist():
            part.append(f" {(t or '').lower()} ")
            size += len(part[-1])
            if size > most:
                yield part
                part, size = [], 0
        if part:
            yield part


#: places that a centroid's mean is taken of at once
_PLACES = 1 << 10


def _k_means(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from the texts farthest from those chosen."""
    start = [int((v @ v.mean(0)).argmax())]
    while len(start) < min(k, len(v)):
        start.append(int((v @ v[start].T).max(1).argmin()))
    centre = v[start].copy()
    for _ in range(rounds):
        own = (v @ centre.T).argmax(1)
        for c in range(len(centre)):
            if (own == c).any():
                # some places at a time: no second copy of the texts beside the first
                m = np.concatenate([v[own == c, a:a + _PLACES].mean(0) for a in range(0, v.shape[1], _PLACES)])
                centre[c] = m / max(np.sqrt(m @ m), 1e-12)
    return centre


def _frequencies(labelled: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts with letters, and of those with each place."""
    def run(batches):
        total, seen = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for low in _texts(batch.column("text")):
                _, place, _, letters = _grams(low)
                total += np.bincount(place, minlength=DIMS)
                seen += int((letters > 0).sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.append(at, -1).astype(np.int32)), "n": pa.array(np.append(total[at], seen))})

    got = {r.place: r.n for r in labelled.select("text").mapInArrow(released(run), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}
    out = np.zeros(DIMS)
    for k, n in got.items():
        if k >= 0:
            out[k] = n
    return got.get(-1, 0), out


def _floors(labelled: DataFrame, model: dict) -> np.ndarray:
    """Each language's rejection threshold, from the cosines of all its texts
    with its own centroids."""
    index = {x: k for k, x in enumerate(model["langs"])}

    def run(batches):
        ready = _ready(model)
        total = np.zeros(len(index) * (STEPS + 1), dtype=np.int64)
        for batch in batches:
            names, at = batch.column("lang").to_pylist(), 0
            for low in _texts(batch.column("text")):
                lang = np.array([index.get(x, -1) for x in names[at:at + len(low)]])
                cos, letters = _similar(low, ready)
                ok = np.flatnonzero((letters > 0) & (lang >= 0))
                full = cos[ok, lang[ok]] / np.sqrt(np.minimum(letters[ok] / FULL, 1))
                total += np.bincount(lang[ok] * (STEPS + 1) + (np.clip(full, 0, 1) * STEPS).astype(np.int64), minlength=len(total))
                at += len(low)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

    total = np.zeros((len(index), STEPS + 1))
    for r in labelled.select("lang", "text").mapInArrow(released(run), "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        total[r["at"] // (STEPS + 1), r["at"] % (STEPS + 1)] = r["n"]
    below = np.cumsum(total, axis=1)
    return np.array([REJECT * int(np.searchsorted(b, LOW * b[-1], side="right")) / STEPS for b in below])


def fit(labelled: DataFrame, sample: int = SAMPLE) -> dict:
    """A model from ``labelled (text, lang, key)``. Each language gives its
    ``sample`` or so texts of the smallest hash of key to the centroids; their
    vectors are what comes to the driver."""
    labelled = labelled.filter("lang is not null and text is not null")
    # a row for each language, as the model has: literals, so no text is shuffled
    sizes = labelled.groupBy("lang").count().collect()
    rate = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], float(r["count"]))])[F.col("lang")] if sizes else F.lit(0.0)
    part = F.pmod(F.xxhash64(F.lit("langid"), F.col("key")), F.lit(1 << 30)) / float(1 << 30)
    taken = labelled.filter(part * rate < sample).select("lang", "text")

    def vectors(batches):
        for batch in batches:
            names, at = batch.column("lang").to_pylist(), 0
            for low in _texts(batch.column("text")):
                doc, place, counts, letters = _grams(low)
                first = np.searchsorted(doc, np.arange(len(low) + 1))
                keep = [i for i in range(len(low)) if letters[i]]
                place, counts = place.astype(np.uint16), np.minimum(counts, 65535).astype(np.uint16)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([names[at + i] for i in keep], type=pa.string()),
                    "places": pa.array([place[first[i]:first[i + 1]].tobytes() for i in keep], type=pa.binary()),
                    "counts": pa.array([counts[first[i]:first[i + 1]].tobytes() for i in keep], type=pa.binary())})
                at += len(low)

    rows = taken.mapInArrow(released(vectors), "lang string, places binary, counts binary").collect()
    names = sorted({r.lang for r in rows})
    if not names:
        return {"langs": [], "idf": np.ones(DIMS, np.float32), "centres": np.zeros((0, DIMS), np.float32), "of": np.zeros(0, int), "floor": np.zeros(0)}
    seen, having = _frequencies(labelled)
    idf = (np.log((1 + seen) / (1 + having)) + 1).astype(np.float32)
    rows.sort(key=lambda r: (r.lang, r.places, r.counts))
    centres, of = [], []
    for k, name in enumerate(names):
        own = [r for r in rows if r.lang == name]
        doc = np.repeat(np.arange(len(own)), [len(r.places) // 2 for r in own])
        place = np.concatenate([np.frombuffer(r.places, dtype=np.uint16) for r in own]).astype(np.int64)
        counts = np.concatenate([np.frombuffer(r.counts, dtype=np.uint16) for r in own]).astype(np.float32)
        v = np.zeros((len(own), DIMS), dtype=np.float32)
        v[doc, place] = _weigh(doc, place, counts, len(own), idf)
        del doc, place, counts
        c = _k_means(v, CENTROIDS)
        del v               # before the next language has its own
        give_back()
        centres.append(c)
        of += [k] * len(c)
    model = {"langs": names, "idf": idf, "centres": np.concatenate(centres).astype(np.float32), "of": np.array(of)}
    return {**model, "floor": _floors(labelled, model)}


def _ready(model: dict) -> dict:
    """The model as a task uses it."""
    return {**model, "across": np.ascontiguousarray(model["centres"].T)}


def _similar(low: list[str], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of lower-cased texts with the languages (each one's nearest
    centroid), and the texts' letters."""
    doc, place, counts, letters = _grams(low)
    every = _cosines(doc, place, _weigh(doc, place, counts, len(low), model["idf"]), len(low), model["across"])
    return np.stack([every[:, model["of"] == k].max(1) for k in range(len(model["langs"]))], axis=1), letters


def _judge(low: list[str], model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased texts: index of the language (-1: none), score, cosine
    and whether the text is rejected."""
    n = len(low)
    if not model["langs"]:
        return np.full(n, -1), np.zeros(n), np.zeros(n), np.ones(n, dtype=bool)
    cos, letters = _similar(low, model)
    known = letters > 0
    best = cos.argmax(1)
    top = cos[np.arange(n), best].astype(np.float64)
    score = 1 / np.exp(20 * (cos - top[:, None])).sum(1)
    rejected = ~known | (top < model["floor"][best] * np.sqrt(np.minimum(letters / FULL, 1)))
    return np.where(known, best, -1), np.where(known, np.clip(score, 0, 1), 0.0), np.where(known, top, 0.0), rejected


def predict(documents: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score, cosine, rejected for each row."""
    def run(batches):
        ready = _ready(model)
        for batch in batches:
            at = 0
            for low in _texts(batch.column("text")):
                best, score, cosine, rejected = _judge(low, ready)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(at, len(low)).cast(pa.int64()),
                    "lang_pred": pa.array([model["langs"][b] if b >= 0 else "und" for b in best], type=pa.string()),
                    "score": pa.array(score.astype(np.float64)), "cosine": pa.array(cosine), "rejected": pa.array(rejected)})
                at += len(low)

    return documents.select("doc_id", "text").mapInArrow(
        released(run), "doc_id long, lang_pred string, score double, cosine double, rejected boolean")


def keep_identified(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of documents, with all their columns, whose text is not
    rejected by the model that ``identify`` learns from them."""
    model = _learn(documents, sample)

    def run(batches):
        ready = _ready(model)
        for batch in batches:
            rejected = [_judge(low, ready)[3] for low in _texts(batch.column("text"))]
            yield batch.filter(pa.array(~np.concatenate(rejected))) if rejected else batch

    return documents.mapInArrow(released(run), documents.schema)


def _learn(documents: DataFrame, sample: int) -> dict:
    return fit(documents.filter(~held_out()).select("text", "lang", F.col("doc_id").alias("key")), sample)


def identify(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learns from the rows of ``documents (doc_id, text, lang)`` that are not
    held out and have a lang, and returns for each row: doc_id, held_out,
    lang_pred, score (0 to 1), cosine, rejected.

    * null text or no letter: lang_pred ``und``, score 0, rejected;
    * very short texts are judged by the few trigrams they have;
    * no labelled row: every row is ``und`` and rejected;
    * null doc_id: never held out; repeated rows: each is judged;
    * extra columns are not read; an empty table gives an empty result.
    """
    out = predict(documents, _learn(documents, sample))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cosine", "rejected")
