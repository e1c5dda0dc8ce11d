"""Fill-in-middle transformation by block rotation in place, and its exact inverse.

A text is cut into units (white space and the word behind it; white space at the end is a unit of its
own). Two cuts drawn from the document's key part it into prefix, middle and suffix. The
sentinels are inserted at the cuts of a bytearray, then neighbouring segments are
exchanged by three reversals each: both parts, then the whole. The inverse finds the sentinels,
exchanges the segments back the same way and deletes the sentinels.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def unit_ends(data: bytes) -> np.ndarray:
    """Offsets at which the units of ``data`` end."""
    if not data:
        return np.zeros(0, np.int64)
    word = ~_SPACE[np.frombuffer(data, np.uint8)]
    ends = np.flatnonzero(word & ~np.r_[word[1:], False]) + 1
    return ends if word[-1] else np.r_[ends, len(data)]


def exchange(buf: bytearray, start: int, mid: int, end: int) -> None:
    """``buf[start:mid]`` and ``buf[mid:end]`` change places, by three reversals."""
    buf[start:mid] = buf[start:mid][::-1]
    buf[mid:end] = buf[mid:end][::-1]
    buf[start:end] = buf[start:end][::-1]


def draws(seed: int, key: str) -> list[int]:
    """The first four 32-bit numbers of the key's sha256."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4)]


def rotate(data: bytes, a: int, b: int, form: str) -> bytes:
    """``data`` cut at ``a`` and ``b``, its parts behind their sentinels in the order of ``form``."""
    buf = bytearray(data)
    buf[b:b] = SUFFIX
    buf[a:a] = MIDDLE
    buf[0:0] = PREFIX
    middle = len(PREFIX) + a
    suffix = middle + len(MIDDLE) + (b - a)
    exchange(buf, middle if form == "psm" else 0, suffix, len(buf))
    return bytes(buf)


def unrotate(data: bytes, form: str) -> bytes:
    """What :func:`rotate` was given. No part holds a sentinel, so each is found once."""
    if form == "plain":
        return data
    buf = bytearray(data)
    middle = buf.index(MIDDLE)
    if form == "psm":                                   # <P>p <S>s <M>m
        suffix = buf.index(SUFFIX)
        exchange(buf, suffix, middle, len(buf))
    else:                                               # <S>s <P>p <M>m
        prefix = buf.index(PREFIX, 0, middle)
        exchange(buf, 0, prefix, len(buf))
    for sign in (SUFFIX, MIDDLE, PREFIX):
        at = buf.index(sign)
        del buf[at:at + len(sign)]
    return bytes(buf)


def _chars(data: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """Per row: key, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output.

    ``rate`` of 100 texts are rotated, ``spm`` of 100 of those in the form spm, as the key's
    hash decides. A null text is an empty one; empty texts and texts that hold a sentinel
    stay plain. Rows with equal key and text give equal rows; a null key hashes as the empty string.
    Other columns are not read.
    """
    src = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"),
                      text_bytes(F.col(f"`{text}`")).alias("body"))
    kind = src.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        n, form, prefix, middle, out = [], [], [], [], []
        for k, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            ends = unit_ends(data)
            h1, h2, h3, h4 = draws(seed, k)
            n.append(len(ends))
            if not data or h3 % 100 >= rate or PREFIX in data or SUFFIX in data or MIDDLE in data:
                form.append("plain"), prefix.append(None), middle.append(None), out.append(data.decode())
                continue
            x, y = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
            a, b = (int(ends[i - 1]) if i else 0 for i in (x, y))
            form.append("spm" if h4 % 100 < spm else "psm")
            prefix.append(_chars(data[:a])), middle.append(_chars(data[a:b]))
            out.append(rotate(data, a, b, form[-1]).decode())
        return {"key": batch.column(0), "n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle, "output": out}

    return map_arrow(src, f"key {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string", run) \
        .withColumnRenamed("key", key)


def restore(rows: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """``rows`` with the exact text that :func:`transform` was given, from output and form alone.

    A null output stays null; a null form counts as plain.
    """
    names = [c for c in rows.columns if c != out]
    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names] + [f"`{out}` string"])
    at, by = names.index(output), names.index(form)

    def run(batch: pa.RecordBatch) -> dict:
        texts = [None if o is None else unrotate(o.encode(), f or "plain").decode()
                 for o, f in zip(batch.column(at).to_pylist(), batch.column(by).to_pylist())]
        return {c: batch.column(i) for i, c in enumerate(names)} | {out: texts}

    return map_arrow(rows.select(*[F.col(f"`{c}`") for c in names]), schema, run)
