"""Fill-in-the-middle transformation on UTF-8 bytes with a sparse exception index.

A text stays the bytes it is.  Its index holds only the multibyte characters:
where each starts and how many bytes beyond one it takes, summed up to it.
Between them a code-point offset and a byte offset differ by a constant, so a
cut is converted by one binary search and an addition; a text of one-byte
characters has an empty index and its cuts are the same in both.

A text is cut into units (lines, or code points).  Two cuts drawn from the
document's hash give prefix, middle and suffix.  The output is the three in
prefix-suffix-middle (``psm``) or suffix-prefix-middle (``spm``) order behind
their marks, or the text itself (``plain``).

Defined results: a null text is empty; an empty text, one that holds a mark and
one that the rate leaves out are plain, with null lengths.  A null id is drawn
as the empty string.  Rows are independent: repeated rows give repeated rows.
Only ``doc_id`` and ``text`` are read; other columns, whatever their names, are
left behind.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
UNITS = ("line", "char")


class Index(NamedTuple):
    """Of each multibyte character its byte offset, its code-point offset and the excess bytes up to and with it."""

    byte: np.ndarray
    point: np.ndarray
    excess: np.ndarray


def index(data: np.ndarray) -> Index:
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at]
    excess = np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)
    before = np.concatenate(([0], excess[:-1])) if len(at) else excess
    return Index(at, at - before, excess)


def to_points(idx: Index, byte: np.ndarray) -> np.ndarray:
    """Code-point offsets of byte offsets that lie between characters."""
    seen = np.searchsorted(idx.byte, byte, side="left")
    return byte - np.concatenate(([0], idx.excess))[seen]


def to_bytes(idx: Index, point: np.ndarray) -> np.ndarray:
    seen = np.searchsorted(idx.point, point, side="left")
    return point + np.concatenate(([0], idx.excess))[seen]


def line_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets behind each line, its newline included; a last line may lack one."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if not len(data) or len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def transform_one(doc_id: int | None, raw: bytes, unit: str, seed: int, rate: int, spm: int) -> tuple:
    """(units, form, prefix, middle and suffix in code points, output bytes); the lengths are None for a plain text."""
    data = np.frombuffer(raw, np.uint8)
    idx = index(data)
    if unit == "line":
        ends = line_ends(data)
        n = len(ends)
    else:
        n = len(data) - (int(idx.excess[-1]) if len(idx.excess) else 0)
    h = draws(doc_id, seed)
    if not raw or h[2] % 100 >= rate or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, None, raw
    cuts = np.sort(np.array([h[0] % (n + 1), h[1] % (n + 1)], np.int64))
    byte = np.concatenate(([0], ends))[cuts] if unit == "line" else to_bytes(idx, cuts)
    first, second, whole = (int(x) for x in to_points(idx, np.append(byte, len(data))))
    a, b = int(byte[0]), int(byte[1])
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if h[3] % 100 < spm:
        form, out = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, out = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return n, form, first, second - first, whole - second, out


def transform(docs: DataFrame, unit: str = "line", seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, suffix_chars, output) per document row.

    ``rate`` percent of the texts are transformed, ``spm`` percent of these in suffix-prefix-middle order.
    """
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}")

    def run(batch):
        ids = batch.column("doc_id").to_pylist()
        rows = (transform_one(d, t or b"", unit, seed, rate, spm)
                for d, t in zip(ids, batch.column("text").cast(pa.binary()).to_pylist()))
        cols = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        made = [pa.array(c, k) for c, k in zip(cols, kinds)]
        names = ("n", "form", "prefix_chars", "middle_chars", "suffix_chars", "output")
        yield {"doc_id": batch.column("doc_id"), **dict(zip(names, made[:-1])), "output": made[-1].cast(pa.string())}

    return map_batches(texts(docs), run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                       "suffix_chars long, output string")


def restored(transformed: DataFrame) -> DataFrame:
    """``transformed`` with the column ``restored``: the text rebuilt from form and output alone."""
    p, s, m = PREFIX.decode(), SUFFIX.decode(), MIDDLE.decode()
    out = F.col("output")

    def part(start: str, end: str | None = None):
        rest = F.substring_index(out, start, -1)  # each mark is in the output once
        return rest if end is None else F.substring_index(rest, end, 1)

    psm, spm = F.concat(part(p, s), part(m), part(s, m)), F.concat(part(p, m), part(m), part(s, p))
    form = F.col("form")
    return transformed.withColumn("restored", F.when(form == "plain", out).when(form == "psm", psm).otherwise(spm))


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns: lengths of the parts and digests of the output and of the text restored from it."""
    done = restored(transform(docs))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


#: DuckDB's form of ``digests`` over ``documents``.
SQL = r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                      regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                      sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
    h AS (SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
                 CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
                      THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
                 array_to_string(u[b + 1:], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p"""
