"""Fill-in-the-middle transformation of whole texts.

A text is cut at two code-point boundaries. Where a boundary lies in the bytes
is answered by a learned index from rank to offset: the offsets of all
boundaries of a slice of texts are fitted with straight segments, each as long
as an offset bound of ``ERROR`` bytes allows, and every boundary keeps what
its segment is off by as one residual byte. A cut is then predicted from its
segment and corrected by its residual, which is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Texts, longs, map_texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: percentage of texts that are transformed, and of these with the suffix first
TRANSFORMED_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
#: bytes that a segment may be off by; with one more for rounding, a residual fits a byte
ERROR = 100
#: knots that are tried at once when a segment is lengthened, doubled each time
_STEP = 256


class RankIndex:
    """Ascending offsets by rank, as error-bounded segments and residuals."""

    def __init__(self, offsets: np.ndarray):
        steps = np.diff(offsets)
        # between knots offsets lie on a line, so a line near two knots is near all between them
        knots = np.concatenate([[0], np.flatnonzero(steps[1:] != steps[:-1]) + 1, [len(steps)]]) if len(steps) else np.zeros(1, dtype=np.int64)
        x, y = knots.astype(np.float64), offsets[knots].astype(np.float64)
        first, slope, at = [], [], 0
        while True:
            end, best = self._longest(x, y, at)
            first.append(int(knots[at]))
            slope.append(best)
            if end + 1 >= len(knots):
                break
            at = end
        self.first, self.slope = np.array(first, dtype=np.int64), np.array(slope)
        self.base = offsets[self.first]
        self.residual = (offsets - self._predicted(np.arange(len(offsets)))).astype(np.int8)

    @staticmethod
    def _longest(x: np.ndarray, y: np.ndarray, at: int) -> tuple[int, float]:
        """The last knot that one line from knot ``at`` reaches within ERROR of
        all knots on the way, and its slope."""
        low, high, done, step = -np.inf, np.inf, at, _STEP
        while done + 1 < len(x):
            part = slice(done + 1, min(done + 1 + step, len(x)))
            dx, dy = x[part] - x[at], y[part] - y[at]
            lows = np.maximum(np.maximum.accumulate((dy - ERROR) / dx), low)
            highs = np.minimum(np.minimum.accumulate((dy + ERROR) / dx), high)
            broken = np.flatnonzero(lows > highs)
            if len(broken):
                k = int(broken[0])
                if k:
                    low, high, done = lows[k - 1], highs[k - 1], done + k
                break
            low, high, done, step = lows[-1], highs[-1], part.stop - 1, 2 * step
        return done, (low + high) / 2 if done > at else 0.0

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[k] + np.floor(self.slope[k] * (ranks - self.first[k])).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        return self._predicted(ranks) + self.residual[ranks]


def _transform(rows: pa.RecordBatch, texts: Texts, transformed: int, suffix_first: int) -> dict:
    starts = np.append(np.flatnonzero((texts.buf & 0xC0) != 0x80), len(texts.buf))
    index = RankIndex(starts)
    origin = np.searchsorted(starts, texts.bounds)      # rank of each text's first boundary
    n = np.diff(origin)
    draw = [rows.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4)]
    one, two = draw[0] % (n + 1), draw[1] % (n + 1)
    small, large = np.minimum(one, two), np.maximum(one, two)
    cut_1, cut_2 = index.offset(origin[:-1] + small), index.offset(origin[:-1] + large)
    form, output = [], []
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for i in range(len(texts)):
        text = texts.bytes_of(i)
        if not text or draw[2][i] % 100 >= transformed or p in text or s in text or m in text:
            form.append("plain")
            output.append(text)
            continue
        a, b = cut_1[i] - texts.bounds[i], cut_2[i] - texts.bounds[i]
        if draw[3][i] % 100 < suffix_first:
            form.append("spm")
            output.append(b"".join([s, text[b:], p, text[:a], m, text[a:b]]))
        else:
            form.append("psm")
            output.append(b"".join([p, text[:a], s, text[b:], m, text[a:b]]))
    plain = np.array([f == "plain" for f in form], dtype=bool)
    return {"doc_id": rows.column("doc_id").cast(pa.int64()), "n": longs(n), "form": pa.array(form, type=pa.string()),
            "prefix_chars": pa.array(small.astype(np.int64), mask=plain), "middle_chars": pa.array((large - small).astype(np.int64), mask=plain),
            "output": pa.array(output, type=pa.binary()).view(pa.string())}


def fill_in_middle(documents: DataFrame, seed: str = "1", transformed: int = TRANSFORMED_PERCENT,
                   suffix_first: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """doc_id, n (code points), form (plain, psm, spm), prefix_chars,
    middle_chars and output for each row of ``documents (doc_id, text)``.

    All draws come from the sha256 of ``seed:doc_id``, so reruns agree. A text
    that holds one of the three marks stays plain, so an output has one
    reading.

    * null text: as the empty one, which is plain with an empty output;
    * null doc_id: drawn as an empty id; rows with one id share their draws,
      and repeated rows are each returned;
    * texts of any length are transformed whole; extra columns are not read;
      an empty table gives an empty result.
    """
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = documents.select("doc_id", "text", name.alias("name")).select("doc_id", "text", *[
        F.conv(F.substring("name", 8 * k - 7, 8), 16, 10).cast("long").alias(f"h{k}") for k in (1, 2, 3, 4)])
    return map_texts(draws, lambda rows, texts: _transform(rows, texts, transformed, suffix_first),
                     "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that a transformed output was made from."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    body = F.substr(output, F.lit(len(PREFIX) + 1))

    def parts(second: str) -> tuple[Column, Column, Column]:
        rest = F.substring_index(body, second, -1)
        return F.substring_index(body, second, 1), F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)

    prefix, suffix, middle = parts(SUFFIX)
    suffix_, prefix_, middle_ = parts(PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(
        form == "spm", F.concat(prefix_, middle_, suffix_)).otherwise(output)
