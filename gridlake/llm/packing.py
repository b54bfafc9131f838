"""Packing documents into token sequences: concatenate and cut.

All documents' tokens, each document closed by an end id, form one long row of
tokens in the order (partition, place). It is cut into windows of ``WIDTH``
ids, so only the last window is short. Two passes give every document its
global offset: the first tokenises, stores the ids with the tokens before them
in their partition, and the partitions' totals are summed up over the
partitions; the second adds that sum and cuts where windows end. A window that
lies in several tasks reaches its sequence as boundary records.
"""

from __future__ import annotations

import os
import struct
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Texts, longs, slices, store

WIDTH = 1024
END = 0
#: Partition totals up to this number (16 bytes each) are broadcast, more are joined.
BROADCAST_TOTALS = 1 << 20

_loaded: dict = {}


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _loaded[path] = t
    return _loaded[path]


#: A worker remembers the ids of this many chunks, and of as many before them.
_MEMO = 500_000
#: Longer chunks (in bytes), which seldom come again, are not remembered.
_LONGEST = 64
#: Each as columns: name (a hash, sorted), at and size (its bytes in ``text``),
#: begin and count (its ids in ``ids``); without columns if nothing is remembered.
_memo: list[dict] = [{}, {}]
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]

#: white space of kind 4
_BLANKS = [9, 10, 13, 32]


def _kinds() -> np.ndarray:
    """The kind of each character below 65536: 1 letters, 2 digits, 3 other
    visible signs, 4 common white space, 0 all else. A character that is not of
    the same kind in Unicode 3.2 and in Python's version is of kind 0, as the
    tokenizer may know another version."""
    kinds = {"L": 1, "N": 2, "P": 3, "S": 3}
    both = [[kinds.get(u.category(chr(c))[0], 0) for c in range(1 << 16)] for u in (unicodedata, unicodedata.ucd_3_2_0)]
    out = np.where(np.equal(*both), both[0], 0).astype(np.int8)
    out[_BLANKS] = 4
    return out


_KIND = _kinds()
#: whether a piece ends between characters of these kinds, whatever stands around them
_ENDS = np.zeros((5, 5), dtype=bool)
_ENDS[1:4, 1:5] = ~np.eye(3, 4, dtype=bool)
#: the sign by which a byte-level tokenizer's model knows each byte
_SIGN = np.arange(256, dtype="<u2")
_hidden = [*range(33), *range(127, 161), 173]
_SIGN[_hidden] = 256 + np.arange(len(_hidden))


def _kinds_of(buf: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte is of; ``edge`` tells where texts
    begin and end."""
    kind = np.where(buf < 128, _KIND[buf], 0).astype(np.int8)
    for size, low, high, least in ((2, 0xC2, 0xE0, 0x80), (3, 0xE0, 0xF0, 0x800)):
        at = np.flatnonzero((buf >= low) & (buf < high))
        at = at[at <= len(buf) - size]
        code = buf[at].astype(np.int64) - (0xC0 if size == 2 else 0xE0)
        good = np.ones(len(at), dtype=bool)
        for i in range(1, size):
            good &= (buf[at + i] & 0xC0 == 0x80) & ~edge[at + i]
            code = code << 6 | buf[at + i] & 0x3F
        own = np.where(good & (code >= least), _KIND[code & 0xFFFF], 0)
        keep = own > 0
        for i in range(size):
            kind[at[keep] + i] = own[keep]
    return kind


def _cuts(buf: np.ndarray, kind: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Where texts are cut, ``edge`` included."""
    cut = edge.copy()
    if len(buf) < 2:
        return cut
    before, behind = kind[:-1], kind[1:]
    # an apostrophe may belong to the letters behind it
    cut[1:-1] |= _ENDS[before, behind] & ((buf[:-1] != 39) | (behind == 4))
    # the last of white space before a visible sign is apart from the rest of it
    last = (before == 4) & (behind > 0) & (behind < 4) & ~edge[1:-1]
    cut[1:-2] |= last[1:] & (kind[:-2] == 4)
    # and, if no space, from the sign
    sure = edge[:-2].copy()
    sure[1:] |= kind[:-2] > 0
    cut[1:-1] |= last & (buf[:-1] != 32) & sure
    return cut


def cuts_by_kind(tokenizer) -> bool:
    """Whether the tokenizer is a byte-level one without a normalizer. Its
    pieces hold letters, digits or other visible signs, each with one space in
    front or none, or white space: a text can be cut where these kinds change,
    but for an apostrophe before letters, before the white space behind them,
    and around the last of white space, if no space, before the next."""
    import json
    made = json.loads(tokenizer.to_str())
    before = made["pre_tokenizer"] or {}
    return (made["normalizer"] is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
            and before.get("use_regex", True) and not made["model"].get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in made["added_tokens"]))


def _whole(tokenizer, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and the number of them in each text."""
    coded = [e.ids for e in tokenizer.encode_batch_fast(
        [texts.bytes_of(i).decode("utf-8", "replace") for i in range(len(texts))], add_special_tokens=False)]
    return np.array([x for ids in coded for x in ids], dtype=np.int64), np.array([len(ids) for ids in coded], dtype=np.int64)


def _runs(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places of runs of ``count`` places each."""
    upto = np.cumsum(count)
    return np.repeat(begin - upto + count, count) + np.arange(int(upto[-1]) if len(upto) else 0)


def _found(memo: dict, buf: np.ndarray, start: np.ndarray, size: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which chunks the memo holds, and their rows in it."""
    if not memo:
        return np.zeros(len(name), dtype=bool), np.zeros(len(name), dtype=np.int64)
    row = np.minimum(np.searchsorted(memo["name"], name), len(memo["name"]) - 1)
    hit = (memo["name"][row] == name) & (memo["size"][row] == size)
    at = np.flatnonzero(hit)
    # equal names are equal chunks: checked byte by byte
    same = buf[_runs(start[at], size[at])] == memo["text"][_runs(memo["at"][row[at]], size[at])]
    if not same.all():
        hit[at] = np.logical_and.reduceat(same, np.cumsum(size[at]) - size[at])
    return hit, row


def _with(memo: dict, more: dict) -> dict:
    """A memo and more chunks, sorted by name."""
    if not memo:
        return more
    more = more | {"at": more["at"] + len(memo["text"]), "begin": more["begin"] + len(memo["ids"])}
    order = np.argsort(np.concatenate([memo["name"], more["name"]]), kind="stable")         # two sorted runs: merged
    out = {}
    for c in memo:
        out[c] = np.concatenate([memo[c], more[c]])
        if c not in ("text", "ids"):
            out[c] = out[c][order]
    return out


def _remembered(tokenizer, buf: np.ndarray, start: np.ndarray, end: np.ndarray, name: np.ndarray,
                single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the distinct chunks, sorted by name, in one row, and the number of each chunk's."""
    young, old = _memo
    size = end - start
    known, row = _found(young, buf, start, size, name)
    at = np.flatnonzero(~known)
    again, row[at] = _found(old, buf, start[at], size[at], name[at])
    again, new = at[again], at[~again]
    raw = buf.tobytes()
    made = _encoded(tokenizer, [raw[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())], single[new].tolist())
    known = np.flatnonzero(known)
    count = np.zeros(len(name), dtype=np.int64)
    count[new] = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // 4
    for memo, some in ((young, known), (old, again)):
        if len(some):
            count[some] = memo["count"][row[some]]
    begin = np.cumsum(count) - count
    ids = np.empty(int(count.sum()), dtype="<u4")
    ids[_runs(begin[new], count[new])] = np.frombuffer(b"".join(made), dtype="<u4")
    for memo, some in ((young, known), (old, again)):
        if len(some):
            ids[_runs(begin[some], count[some])] = memo["ids"][_runs(memo["begin"][row[some]], count[some])]
    at = at[size[at] <= _LONGEST]
    if len(at):
        _memo[0] = _with(young, {
            "name": name[at], "at": np.cumsum(size[at]) - size[at], "size": size[at].astype(np.int16),
            "begin": np.cumsum(count[at]) - count[at], "count": count[at].astype(np.int16), "text": buf[_runs(start[at], size[at])], "ids": ids[_runs(begin[at], count[at])]})
        if len(_memo[0]["name"]) > _MEMO:
            _memo[:] = [{}, _memo[0]]
    return ids, count


def _encoded(tokenizer, chunks: list[bytes], single: list[bool] | None = None) -> list[bytes]:
    """The ids of each chunk. Those that are a ``single`` piece go to the
    tokenizer's model at once: what else it does to a text costs it more than
    that. If not told, these are the ASCII words, with a space before them or none."""
    if single is None:
        single = [(c[1:] if c[:1] == b" " else c).isalpha() for c in chunks]
    model, out, rest = tokenizer.model.tokenize, [b""] * len(chunks), []
    signs = _SIGN[np.frombuffer(b"".join(chunks), dtype=np.uint8)].tobytes().decode("utf-16-le")
    end = 0
    for i, (chunk, alone) in enumerate(zip(chunks, single)):
        start, end = end, end + len(chunk)
        if alone:
            ids = [t.id for t in model(signs[start:end])]
            out[i] = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)
        else:
            rest.append(i)
    for i, ids in zip(rest, _marked(tokenizer, [chunks[i] for i in rest]) if rest else []):
        out[i] = ids
    return out


def _marked(tokenizer, chunks: list[bytes]) -> list[bytes]:
    """The ids of each chunk. An added token of the tokenizer, which is found
    before all else, stands between chunks, so that one call does them all."""
    for mark, token in tokenizer.get_added_tokens_decoder().items():
        joined = token.content.encode().join(chunks).decode("utf-8", "replace")
        ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
        end = np.append(np.flatnonzero(ids == mark), len(ids)).tolist()
        if len(end) == len(chunks):
            raw = ids.tobytes()
            return [raw[4 * a:4 * b] for a, b in zip([0, *(e + 1 for e in end[:-1])], end)]
    coded = tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)
    return [np.array(e.ids, dtype="<u4").tobytes() for e in coded]


def _single(buf: np.ndarray, kind: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which chunks are surely one piece: signs of one kind, with a space before them or none."""
    if not len(start):
        return np.zeros(0, dtype=bool)
    run = np.concatenate([[0], np.cumsum(kind[1:] != kind[:-1])])
    second = np.minimum(start + 1, end - 1)
    led = (buf[start] == 32) & (kind[second] < 4)
    begin = np.where(led, second, start)
    return (run[begin] == run[end - 1]) & (kind[begin] > 0)


def _by_chunks(tokenizer, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The same: texts are cut where a piece surely ends, and a chunk that
    occurs many times is tokenised once."""
    buf, n = texts.buf, len(texts.buf)
    raw = buf.tobytes()
    if any(t.content.encode() in raw for t in tokenizer.get_added_tokens_decoder().values()):
        return _whole(tokenizer, texts)
    edge = np.zeros(n + 1, dtype=bool)
    edge[texts.bounds] = True
    kind = _kinds_of(buf, edge)
    cut = np.flatnonzero(_cuts(buf, kind, edge))
    start, length = cut[:-1], np.diff(cut)
    name, first, same = np.unique(texts.span_hashes(start, cut[1:]), return_index=True, return_inverse=True)
    # equal names are equal chunks: checked byte by byte
    model = start[first][same]
    if (length[first][same] != length).any() or (buf[np.repeat(model - start, length) + np.arange(n)] != buf).any():
        return _whole(tokenizer, texts)
    begin, end = start[first], cut[1:][first]
    flat, count = _remembered(tokenizer, buf, begin, end, name, _single(buf, kind, begin, end))
    begin = np.cumsum(count) - count
    every = count[same]
    total = np.concatenate([[0], np.cumsum(every)])
    return flat[_runs(begin[same], every)], np.diff(total[np.searchsorted(cut, texts.bounds)])


def tokens(documents: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Pass one, stored: part, before (tokens of the part before the row),
    doc_id, doc_tokens, and ids with the end id, as little-endian unsigned
    numbers of two bytes, or of four if the vocabulary needs them.
    ``tokenizer`` is a path that every executor can read."""
    code = "<u2" if max(_tokenizer(tokenizer).get_vocab_size(), end + 1) <= 1 << 16 else "<u4"
    encode = _by_chunks if cuts_by_kind(_tokenizer(tokenizer)) else _whole

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b, texts in slices(batch.column("text"), 2 * SLICE_BYTES):
                ids, n = encode(_tokenizer(tokenizer), texts)
                ids = np.insert(ids, np.cumsum(n), end).astype(code)
                n = n + 1
                upto = np.cumsum(n)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(n), part, dtype=np.int32)), "before": longs(before + upto - n),
                    "doc_id": batch.column("doc_id").slice(a, b - a).cast(pa.int64()), "doc_tokens": longs(n),
                    "ids": pa.array([x.tobytes() for x in np.split(ids, upto[:-1])], type=pa.binary())})
                before += int(upto[-1])

    out = documents.select("doc_id", "text").mapInArrow(run, "part int, before long, doc_id long, doc_tokens long, ids binary")
    out = store(out, "tokens")
    # one row for each task of the pass above
    totals = out.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = store(totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base")), "token-totals", 1)
    few = totals.count() <= BROADCAST_TOTALS
    out = out.join(F.broadcast(totals) if few else totals, "part")
    return out.select("doc_id", "doc_tokens", (F.col("base") + F.col("before")).alias("at"), "ids", F.lit(code).alias("code"))


def _pieces(width: int):
    """The pieces of each document, cut where windows end."""
    def run(batches):
        for batch in batches:
            at, n = batch.column("at").to_numpy(), batch.column("doc_tokens").to_numpy()
            ids = batch.column("ids")
            code = batch.column("code")[0].as_py() if batch.num_rows else "<u4"
            first, last = at // width, (at + n - 1) // width
            count = last - first + 1
            row = np.repeat(np.arange(len(n)), count)
            window = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
            start = np.maximum(window * width, at[row])
            length = np.minimum((window + 1) * width, at[row] + n[row]) - start
            for a in range(0, len(row), 4096):
                b = slice(a, a + 4096)
                own, cut, held = [], start[b] - at[row[b]], {}
                for i, k, m in zip(row[b].tolist(), cut.tolist(), length[b].tolist()):
                    if i not in held:
                        held = {i: np.frombuffer(ids[i].as_py(), dtype=code)}
                    own.append(held[i][k:k + m].astype("<u4").tobytes())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(pa.array(row[b])), "start": longs(cut), "length": longs(length[b]),
                    "ids": pa.array(own, type=pa.binary()), "doc_tokens": longs(n[row[b]]),
                    "sequence_id": longs(window[b]), "offset": longs(start[b] - window[b] * width)})
    return run


def pack(documents: DataFrame, tokenizer: str, width: int = WIDTH, end: int = END) -> DataFrame:
    """One row per piece of the rows of ``documents (doc_id, text)``: doc_id,
    start (ids of the document before the piece), length, ids (binary,
    little-endian unsigned 32-bit), doc_tokens, sequence_id and offset there.

    Sequences are numbered from 0 without gaps, and all but the last hold
    ``width`` ids.

    * null or empty text: one piece that is the end id alone;
    * null doc_id: packed as any other; repeated rows are each packed;
    * a text of any length is packed whole, over as many sequences as it needs;
    * extra columns are not read; an empty table gives an empty result.
    """
    return tokens(documents, tokenizer, end).mapInArrow(
        _pieces(width), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def _merged(batches):
    """Neighbouring pieces of a sequence as one record."""
    held = None
    for batch in batches:
        out = []
        for s, o, ids, doc in zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "offset", "ids", "doc_id"))):
            if held and held[0] == s and held[1] + sum(map(len, held[2])) // 4 == o:
                held[2].append(ids)
                held[3].append((o, doc))
            else:
                if held:
                    out.append(held)
                held = (s, o, [ids], [(o, doc)])
        yield _records(out)
    yield _records([held] if held else [])


def _records(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "sequence_id": pa.array([r[0] for r in rows], type=pa.int64()), "offset": pa.array([r[1] for r in rows], type=pa.int64()),
        "ids": pa.array([b"".join(r[2]) for r in rows], type=pa.binary()),
        "starts": pa.array([[o for o, _ in r[3]] for r in rows], type=pa.list_(pa.int64())),
        "doc_ids": pa.array([[d for _, d in r[3]] for r in rows], type=pa.list_(pa.int64()))})


def sequences(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """The sequences of ``pack``: sequence_id, ids (binary as there), starts
    (offsets at which its pieces begin), doc_ids (of its pieces), n_ids, and
    padded (the length to pad to: the width, or n_ids if that is a power of
    two). Windows that one task holds whole need no shuffle; the others, at
    most two for each run of a task's pieces, meet by sequence_id, and none
    has more than ``width`` ids."""
    records = store(pieces.mapInArrow(_merged, "sequence_id long, offset long, ids binary, starts array<long>, doc_ids array<long>"), "windows")
    whole = F.length("ids") == 4 * width
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "starts", "doc_ids")))
    edges = records.filter(~whole).groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p.ids", F.lit(b""), lambda x, y: F.concat(x, y)).alias("ids"),
        F.flatten("p.starts").alias("starts"), F.flatten("p.doc_ids").alias("doc_ids"))
    out = records.filter(whole).select("sequence_id", "ids", "starts", "doc_ids").union(edges)
    n = (F.length("ids") / 4).cast("long")
    return out.select("*", n.alias("n_ids"), F.when(F.bit_count(n) == 1, n).otherwise(F.lit(width).cast("long")).alias("padded"))
