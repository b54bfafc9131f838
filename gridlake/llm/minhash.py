"""Near-duplicate groups by SetSketch registers.

A text's set holds its distinct five-word shingles. A sketch has
``REGISTERS`` registers; each keeps ``floor(1 - log_BASE(x))`` of the smallest
of the exponential values x that the shingles draw for it, so the registers
are exponentially spaced, mergeable by maximum, and two sets agree in a
register with a probability close to their Jaccard similarity. The values of
all registers come from one Poisson process per shingle (an arrival's register
is uniform, so each register sees an independent exponential stream), which is
followed only as far as the smallest arrivals of a set of its size can lie.

Texts with one set are one node. Registers in bands of ``ROWS`` name buckets;
a bucket's nodes are dealt by hash into blocks of some ``BLOCK`` nodes, with
two of the bucket's nodes in each of them, so no bucket is capped and none
comes into one task. For the pairs of a block the similarity is estimated by
maximum likelihood from the numbers of larger, smaller and equal registers,
and a forest of likely pairs leaves the task: never more than one pair a node.

Pairs are decided on full sets, which are read for nodes with a likely partner
only. First every node is verified with one partner, then the forests' pairs
between what is not connected yet. Last, buckets that still hold several
components are compared between components, all blocks with all but those of
one and the same component, until every likely pair in a bucket is connected
or has been verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _P, Texts, components, free_name, longs, map_texts, maybe_in, mix, released, store

SHINGLE = 5
ROWS, BANDS = 6, 26
REGISTERS = ROWS * BANDS
BASE = 1.02
#: Arrivals followed for each register and set on average: one stays empty
#: with probability exp(-9).
ARRIVALS = 9
LOWEST = -400
#: Pairs whose estimate is this far below the threshold (over five standard
#: deviations of the estimate) are not verified.
MARGIN = 0.16
#: Nodes of a bucket that are compared in one piece, about.
BLOCK = 48
#: Pairs whose estimate is this far above the threshold are nearly sure.
SURE = 0.06


_PLACE = [int(mix(np.array([k + 1], dtype=np.uint64))[0]) | 1 for k in range(SHINGLE)]
_HASH_BITS = np.uint64(52)


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as 52-bit hashes, ascending within each text, and the
    number of them in each text. Fewer words than a shingle: the whole
    sequence is the one shingle."""
    h = texts.hashes(lower=True)
    n = np.diff(texts.first)
    doc = texts.doc()
    full = np.zeros(len(h), dtype=np.uint64)
    whole = max(len(h) - SHINGLE + 1, 0)
    for k in range(SHINGLE):
        full[:whole] += h[k:whole + k] * np.uint64(_PLACE[k])
    inside = np.zeros(len(h), dtype=bool)
    inside[:whole] = doc[:whole] == doc[SHINGLE - 1:]
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)):
        at = texts.first[i]
        own = sum(int(h[at + k]) * _PLACE[k] for k in range(n[i])) + int(n[i])
        full[at], inside[at] = own & (1 << 64) - 1, True
    value = (mix(full[inside]) >> np.uint64(64 - 52)) | (doc[inside].astype(np.uint64) << _HASH_BITS)
    value = np.sort(value)
    new = np.ones(len(value), dtype=bool)
    new[1:] = value[1:] != value[:-1]
    value = value[new]
    counts = np.bincount((value >> _HASH_BITS).astype(np.int64), minlength=len(n)).astype(np.int64)
    return value & np.uint64((1 << 52) - 1), counts


def registers(value: np.ndarray, counts: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """The sketch of each set, given as flat distinct hashes and set sizes."""
    doc = np.repeat(np.arange(len(counts)), counts)
    least = np.full(len(counts) * m, np.inf)
    limit = (ARRIVALS * m / np.maximum(counts, 1))[doc]
    seed, x, step, doc = value, np.zeros(len(value)), 0, doc * m
    while len(seed):
        step += 1
        r = mix(seed + np.uint64(step * _P & (1 << 64) - 1))
        x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        near = np.flatnonzero(x < limit)
        seed, x, limit, doc, r = seed[near], x[near], limit[near], doc[near], r[near]
        np.minimum.at(least, doc + ((r * np.uint64(_P)) >> np.uint64(32)).astype(np.int64) % m, x)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least / m) / np.log(BASE))
    return np.maximum(k, LOWEST).astype(np.int16).reshape(-1, m)


def band_names(reg: np.ndarray) -> np.ndarray:
    """A 64-bit name for each band of each sketch."""
    parts = reg.reshape(len(reg), BANDS, ROWS).astype(np.int64).view(np.uint64)
    name = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_P), parts.shape[:2])
    for k in range(ROWS):
        name = mix(name ^ parts[:, :, k] + np.uint64(k))
    return name


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches with known
    set sizes, on a grid of hundredths."""
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    j = np.linspace(0.005, 0.995, 100)[None, :]
    j = np.minimum(j, np.minimum(u / (1 - u), (1 - u) / u) - 1e-6)

    def p(x):
        return np.clip(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-9, 1)

    up, down = p(u - (1 - u) * j), p(1 - u - u * j)
    fit = more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-9, 1))
    best = fit.argmax(1)
    return j[np.arange(len(j)), best]


def _sketch(rows: pa.RecordBatch, texts: Texts) -> dict:
    value, counts = shingles(texts)
    reg = registers(value, counts)
    return {
        "doc_id": rows.column("doc_id").cast(pa.int64()), "seen": rows.column("seen"), "node": longs(_node(value, counts)),
        "n_shingles": longs(counts),
        "registers": pa.array([reg[i].tobytes() for i in range(len(counts))], type=pa.binary()),
    }


def _node(value: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One name for each set: equal sets have equal names."""
    sums = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(mix(value), out=sums[1:])
    at = np.concatenate([[0], np.cumsum(counts)])
    return mix(sums[at[1:]] - sums[at[:-1]] + counts.astype(np.uint64) * np.uint64(_P))


def _sets(rows: pa.RecordBatch, texts: Texts) -> dict:
    value, counts = shingles(texts)
    at = np.concatenate([[0], np.cumsum(counts)])
    return {"node": longs(_node(value, counts)), "want": rows.column("want"),
            "elements": pa.array([value[at[i]:at[i + 1]].tobytes() for i in range(len(counts))], type=pa.binary())}


def _bands(batches):
    for batch in batches:
        reg = np.frombuffer(b"".join(batch.column("registers").to_pylist()), dtype=np.int16).reshape(-1, REGISTERS)
        node = batch.column("node").to_numpy()
        yield pa.RecordBatch.from_pydict({"bucket": longs(band_names(reg).ravel()), "node": longs(np.repeat(node, BANDS))})


class _Nodes:
    """The nodes of a block, or of two."""

    def __init__(self, blocks: list[pa.StructArray], percent: int, joined: dict | None = None):
        self.percent, self.first, self.joined = percent, len(blocks[0]), {} if joined is None else joined
        self.has = {f.name for f in blocks[0].type}
        field = {c: [x for b in blocks for x in b.field(c).to_pylist()] for c in self.has}
        self.node, self.n = np.array(field["node"], dtype=np.int64), np.array(field["n_shingles"], dtype=np.float64)
        self.reg = np.frombuffer(b"".join(field["registers"]), dtype=np.int16).reshape(-1, REGISTERS)
        self.set = [np.frombuffer(x, dtype=np.uint64) for x in field.get("elements", [])]
        own = [self.top(c) for c in field.get("comp", field["node"])]
        self.comp, seen = np.array(own, dtype=np.int64), {}
        # connected by links found before
        self.root = [seen.setdefault(c, i) for i, c in enumerate(own)]

    def top(self, comp: int) -> int:
        """The component that holds ``comp`` by the links that this task has found."""
        while comp in self.joined:
            comp = self.joined[comp]
        return comp

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def likely(self, across: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (i, j) of different components that are not clearly below the
        threshold, inside one block or across two, and their estimates."""
        if across:
            i, j = np.indices((self.first, len(self.node) - self.first)).reshape(2, -1)
            j = j + self.first
        else:
            i, j = np.triu_indices(len(self.node), 1)
        n = self.n
        keep = (self.comp[i] != self.comp[j]) & (100 * np.minimum(n[i], n[j]) >= self.percent * np.maximum(n[i], n[j]))
        i, j = i[keep], j[keep]
        same = (self.reg[i] == self.reg[j]).sum(1) if len(i) else np.zeros(0)
        near = same >= (self.percent / 100 - 2 * MARGIN) * REGISTERS
        i, j = i[near], j[near]
        if not len(i):
            return i, j, np.zeros(0)
        value = likely_similarity(self.reg[i], self.reg[j], n[i], n[j])
        near = value >= self.percent / 100 - MARGIN
        return i[near], j[near], value[near]

    def forest(self, across: bool) -> dict:
        """Likely pairs that connect all that are connected by likely ones;
        nearly sure ones first, those with the smallest node before others."""
        i, j, value = self.likely(across)
        sure = value >= self.percent / 100 + SURE
        least = np.minimum(self.node[i], self.node[j])
        out = []
        for k in np.lexsort((-value, np.where(sure, least, 0), ~sure)):
            x, y = int(i[k]), int(j[k])
            if self.find(x) != self.find(y):
                self.root[self.find(x)] = self.find(y)
                out.append((*sorted((int(self.node[x]), int(self.node[y])), reverse=True), float(value[k])))
        return {"a": [x for x, _, _ in out], "b": [x for _, x, _ in out], "likely": [x for _, _, x in out]}

    def partners(self, across: bool) -> dict:
        """Nodes with a likely partner in another component."""
        i, j, _ = self.likely(across)
        return {"node": self.node[np.unique(np.concatenate([i, j]))].tolist()}

    def links(self, across: bool) -> dict:
        """Verified links between components that connect all that are
        connected by verified links; from the likeliest pair on."""
        i, j, value = self.likely(across)
        out = []
        for k in np.argsort(-value, kind="stable"):
            x, y = int(i[k]), int(j[k])
            if self.find(x) != self.find(y) and _similar(self.set[x], self.set[y], self.percent):
                self.root[self.find(x)] = self.find(y)
                self.joined[self.top(int(self.comp[x]))] = self.top(int(self.comp[y]))
                out.append((int(self.node[x]), int(self.node[y])))
        return {"a": [x for x, _ in out], "b": [y for _, y in out]}


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _in_blocks(percent: int, what: str, schema: dict):
    """``what`` of _Nodes for each row: inside its block (members), or across
    its two blocks (members, others). A task returns a node of a bucket once,
    and no second link between components that it has linked, however many
    pairs of blocks it meets (it forgets after _REMEMBERED of them)."""
    def run(batches):
        joined, given = {}, set()
        for batch in batches:
            if len(joined) > _REMEMBERED or len(given) > _REMEMBERED:
                joined.clear()
                given.clear()
            out = {c: [] for c in schema}
            columns = [c for c in ("members", "others") if c in batch.schema.names]
            for row in range(batch.num_rows):
                blocks = [batch.column(c).slice(row, 1).flatten() for c in columns]
                got = getattr(_Nodes(blocks, percent, joined), what)(len(blocks) == 2)
                if "bucket" in out:
                    bucket = batch.column("bucket")[row].as_py()
                    new = [x for x in got["node"] if (bucket, x) not in given]
                    given.update((bucket, x) for x in new)
                    got = {"node": new, "bucket": [bucket] * len(new)}
                for c in out:
                    out[c] += got[c]
            yield pa.RecordBatch.from_pydict({c: pa.array(out[c], type=t) for c, t in schema.items()})
    return run


_REMEMBERED = 500_000
_PAIR = {"a": pa.int64(), "b": pa.int64()}


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def run(batches):
        for batch in batches:
            x, y = (([np.frombuffer(s, dtype=np.uint64) for s in batch.column(c).to_pylist()]) for c in ("x", "y"))
            keep = pa.array([_similar(s, t, percent) for s, t in zip(x, y)], type=pa.bool_())
            yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(keep) for c in _PAIR})
    # every a is in few pairs; a b may be in many, and by then rows are long, so the join is split
    both = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(released(run), "a long, b long")


def _sets_of(documents: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(node, elements) for ``wanted (node, rep)``, n at most; rep names one
    row's id and text. Other texts are not moved, but for a few."""
    named = wanted.select(F.col("node").alias("want"), F.coalesce("rep.doc_id", F.lit(0)).alias("id"), F.col("rep.none").alias("none"),
                          F.col("rep.seen").alias("seen"))
    texts = documents.select("text", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("seen"))
    texts = maybe_in(texts, "seen", named, n).filter("_maybe").drop("_maybe")
    found = texts.join(named, ["id", "none", "seen"]).dropDuplicates(["id", "none", "seen"])
    return store(map_texts(found.select("text", "want"), _sets, "node long, want long, elements binary").filter("node = want").drop("want"),
                 "sets", n, 10_000)


def _meetings(members: DataFrame, *fields: str) -> tuple[DataFrame, DataFrame]:
    """``members (bucket, node, comp, fields)`` in blocks: (bucket, members),
    and pairs of blocks of a bucket (bucket, members, others), without what
    holds one component only. A bucket's largest component is not compared
    with itself."""
    sizes = members.groupBy("bucket", "comp").agg(F.count("*").alias("k")).groupBy("bucket").agg(
        F.sum("k").alias("n"), F.max(F.struct("k", "comp"))["comp"].alias("main"), F.count("*").alias("comps"))
    sizes = store(sizes.filter("comps > 1"), "bucket-sizes")
    dealt = members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.ceil(F.col("n") / BLOCK)))
    blocks = dealt.groupBy("bucket", "block", "n", "main").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.collect_list(F.struct("node", "comp", *fields)).alias("members"))
    blocks = store(blocks, "meeting-blocks")
    only_main = (F.col("low") == F.col("main")) & (F.col("high") == F.col("main"))
    many = blocks.filter(F.col("n") > BLOCK).withColumn("only_main", only_main)
    other = many.select("bucket", F.col("block").alias("other"), F.col("members").alias("others"), F.col("only_main").alias("main_only"))
    pairs = many.filter("not only_main").join(other, "bucket").filter("main_only or block < other")
    return blocks.filter("low < high").select("bucket", "members"), pairs.select("bucket", "members", "others")


def _across(members: DataFrame, fields: list, percent: int, what: str, schema: dict, types: str) -> DataFrame:
    inside, between = _meetings(members, *fields)
    run = _in_blocks(percent, what, schema)
    return inside.mapInArrow(released(run), types).union(between.mapInArrow(released(run), types))


def _links(documents: DataFrame, nodes: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """Verified links (a, b) that connect the nodes as all their links do, and
    a bound on their number."""
    n_nodes = nodes.count()
    sketches = nodes.select("node", "n_shingles", "registers")
    names = store(nodes.mapInArrow(released(_bands), "bucket long, node long"), "bands")
    # buckets of the same nodes are one bucket
    shared = names.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"),
                                         F.sum(F.shiftright("node", 8)).alias("sum")).filter("lo < hi")
    shared = store(shared.groupBy("lo", "hi", "n", "sum").agg(F.min("bucket").alias("bucket")).select("bucket", "n", "lo", "hi"),
                   "buckets", n_nodes * BANDS // 2)
    active = store(names.join(shared, "bucket"), "active", n_nodes * BANDS, 250_000)
    n_blocks = F.ceil(F.col("n") / BLOCK)
    own = F.array(F.pmod(F.xxhash64("node", "bucket"), n_blocks))
    place = F.when((n_blocks > 1) & F.col("node").isin(F.col("lo"), F.col("hi")), F.sequence(F.lit(0).cast("long"), n_blocks - 1)).otherwise(own)
    blocks = active.select("bucket", "node", F.explode(place).alias("block")).join(sketches, "node").groupBy("bucket", "block").agg(
        F.collect_list(F.struct("node", "n_shingles", "registers")).alias("members"))
    found = blocks.filter(F.size("members") > 1).select("members").mapInArrow(
        released(_in_blocks(percent, "forest", _PAIR | {"likely": pa.float64()})), "a long, b long, likely double")
    found = store(found.groupBy("a", "b").agg(F.max("likely").alias("likely")), "likely")
    n_found = found.count()

    of_found = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = store(nodes.select("node", "rep").join(of_found, "node"), "wanted")
    sets = _sets_of(documents, wanted, min(n_nodes, 2 * n_found))
    # a node's partner: the smallest nearly sure one, or the likeliest
    ends = found.select(F.col("a").alias("u"), F.col("b").alias("v"), "likely").union(found.select("b", "a", "likely"))
    small = F.min(F.when((F.col("likely") >= percent / 100 + SURE) & (F.col("v") < F.col("u")), F.col("v")))
    picks = ends.groupBy("u").agg(small.alias("small"), F.max(F.struct("likely", "v"))["v"].alias("best")).select(
        "u", F.coalesce("small", "best").alias("v"))
    picks = store(picks.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), "picks")
    links = store(_verified(picks, sets, percent), "links")
    labels = store(components(links, n_found), "labels")

    def apart(pairs: DataFrame) -> DataFrame:
        for end in "ab":
            own = labels.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
            pairs = pairs.join(own, end, "left").withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))
        return pairs.filter("comp_a <> comp_b").select("a", "b")

    more = store(apart(found.join(picks, ["a", "b"], "left_anti").select("a", "b")), "more-pairs")
    links = store(links.union(_verified(more, sets, percent)), "links")
    labels = store(components(links, n_found), "labels")

    # buckets in which likely pairs may be left: several blocks, or a pair that failed
    labelled = store(active.join(labels, "node", "left").select("bucket", "node", "n", F.coalesce("comp", "node").alias("comp")), "labelled",
                     n_nodes * BANDS, 250_000)
    failed = apart(found.select("a", "b")).select(F.explode(F.array("a", "b")).alias("node")).distinct()
    left = labelled.filter(F.col("n") > BLOCK).select("bucket").union(labelled.join(failed, "node").select("bucket")).distinct()
    members = store(labelled.join(left, "bucket").select("bucket", "node", "comp"), "left-members")
    near = _across(members.join(sketches, "node"), ["n_shingles", "registers"], percent, "partners",
                   {"bucket": pa.int64(), "node": pa.int64()}, "bucket long, node long")
    near = store(near.distinct(), "partners")
    n_near = near.count()
    if not n_near:
        return links, n_found
    unread = near.select("node").distinct().join(sets.select("node"), "node", "left_anti")
    unread = store(nodes.select("node", "rep").join(unread, "node"), "unread")
    sets = sets.union(_sets_of(documents, unread, min(n_nodes, n_near)))
    members = near.join(members, ["bucket", "node"]).join(sketches, "node").join(sets, "node")
    rest = _across(members, ["n_shingles", "registers", "elements"], percent, "links", _PAIR, "a long, b long")
    links = store(links.union(rest), "links")
    return links, links.count()


def _components(documents: DataFrame, percent: int) -> DataFrame:
    """(doc_id, seen, n_shingles, component_id, kept) of each row; seen is a
    hash of its text."""
    sketched = store(map_texts(documents.select("doc_id", "text", F.xxhash64("text").alias("seen")), _sketch,
                               "doc_id long, seen long, node long, n_shingles long, registers binary"), "sketches")
    rep = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "seen")
    nodes = store(sketched.filter("n_shingles > 0").groupBy("node").agg(
        F.min(rep).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")), "nodes")
    n_nodes = nodes.count()
    edges, n_edges = _links(documents, nodes, percent)
    labels = nodes.select("node", F.col("rep.doc_id").alias("rep")).join(components(edges, n_edges), "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    labels = store(labels, "labelled", n_nodes)
    least = store(labels.groupBy("comp").agg(F.min("rep").alias("component_id")), "least", n_nodes)
    names = store(labels.join(least, "comp").select("node", "component_id"), "names", n_nodes)
    rows = sketched.select("doc_id", "seen", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
    out = rows.filter("node is not null").join(names, "node").select("doc_id", "seen", "n_shingles", "component_id").union(
        rows.filter("node is null").select("doc_id", "seen", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``documents (doc_id, text)``: doc_id, n_shingles,
    component_id, kept.

    Words are the runs of bytes other than space and 9-13, with A-Z taken as
    a-z. Two texts are linked if ``100 * intersection >= percent * union`` of
    their shingle sets. component_id is the smallest doc_id reachable.

    * null or empty text, or no word: n_shingles 0, linked with nothing, own
      doc_id as component;
    * null doc_id: takes part in links, and is kept only if no other id is in
      its component (component_id is then null);
    * repeated rows: each returned; rows with one id share its component when
      their texts are linked;
    * extra columns are not read; an empty table gives an empty result.
    """
    return _components(documents, percent).drop("seen")


def drop_near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of documents, with all their columns, that their group keeps.

    * null or empty text, or no word: kept;
    * null doc_id: kept if no other id is in its group;
    * repeated rows share their fate; of rows that share an id, each has the
      fate of its own text;
    * extra columns are returned as they are; an empty table gives an empty
      result.
    """
    of_id, none, seen, maybe = (free_name(c, documents) for c in ("_id", "_none", "_seen", "_maybe"))
    gone = _components(documents.select("doc_id", "text"), percent).filter("not kept").select(
        F.coalesce("doc_id", F.lit(0)).alias(of_id), F.col("doc_id").isNull().alias(none), F.col("seen").alias(seen)).distinct()
    gone = store(gone, "gone")
    rows = maybe_in(documents.withColumn(seen, F.xxhash64("text")), seen, gone, gone.count(), maybe)
    # only texts that may have to go are moved
    some = rows.filter(maybe).withColumn(of_id, F.coalesce("doc_id", F.lit(0))).withColumn(none, F.col("doc_id").isNull())
    return rows.filter(~F.col(maybe)).select(documents.columns).union(
        some.join(gone, [of_id, none, seen], "left_anti").select(documents.columns))
