"""SentencePiece encoding and decoding through one corpus-wide table of distinct marked words.

A marked word is a run of white-space markers with the characters up to the next one. Where no
piece of the model goes on behind a marker, the library's ids of a text are those of its marked words
in a row. So each distinct word of the corpus is segmented once:

1. a map numbers the distinct words of blocks of documents; documents become the numbers of their words,
   written in buckets of the block's name, so that they need not move again;
2. the blocks' words are dealt by hash to buckets of bounded size; a bucket segments each of its
   words once, whatever number of blocks hold it, and answers every block;
3. a block's answers meet its documents, whose ids are gathered by position.

Words travel once a block, not once an occurrence, so that a frequent word is no hot key.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import Scratch, map_arrow, text_bytes

MARK = "▁"
BLOCK = 32 << 20          # bytes of text whose words are numbered together
DOCS = 256                # of a block that stand in one row of the written table
WORDS = 400_000           # of all blocks together that a bucket answers, about
BUCKETS = 1 << 16         # at most, so that a block's words for a bucket are worth a row; a worker holds a bucket's distinct words only


class Segmenter:
    """One for each Python worker and model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(len(self.sp))]
        self.mark = self.sp.piece_to_id(MARK)
        # white space as it stands, one marker before the text, and no piece that goes on behind a marker
        self.by_word = (not any(MARK in p.lstrip(MARK) for p in pieces) and self.sp.id_to_piece(self.mark) == MARK
                        and self.sp.normalize("  ﬁ  a ") == "▁▁ ﬁ▁▁a▁")

    def words(self, data: bytes) -> list[bytes]:
        """The marked words of a text, each without its first marker; the whole text where words are not independent."""
        if not data:
            return []
        if not self.by_word:
            return [data]
        parts = data.replace(b"\xe2\x96\x81", b" ").split(b" ")
        if b"" not in parts:
            return parts
        out, run = [], b""
        for i, p in enumerate(parts):
            if p:
                out.append(run + p)
                run = b""
            elif i + 1 < len(parts):
                run += b" "
            else:
                out.append(run)                          # markers at the end of the text
        return out

    def ids(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word with its first marker, as the library gives them."""
        got = self.sp.encode([w.decode() for w in words], num_threads=1)
        if self.by_word:                                 # a lone marker is no text to the library
            got = [[self.mark] if not w else g for w, g in zip(words, got)]
        return got


_SEGMENTERS: dict[str, Segmenter] = {}


def segmenter(path: str) -> Segmenter:
    if path not in _SEGMENTERS:
        _SEGMENTERS[path] = Segmenter(path)
    return _SEGMENTERS[path]


def _squeeze(a: np.ndarray) -> bytes:
    """Whole numbers below 2**32, byte by byte (all lowest bytes first), as a zstd frame."""
    planes = np.ascontiguousarray(a.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _swell(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack(words: list[bytes]) -> tuple[bytes, bytes]:
    """Lengths and bytes of words, as zstd frames."""
    return _squeeze(np.fromiter(map(len, words), np.uint32, len(words))), zstandard.ZstdCompressor(level=3).compress(b"".join(words))


def _unpack(sizes: bytes, data: bytes) -> list[bytes]:
    ends = np.cumsum(_swell(sizes).astype(np.int64)).tolist()
    body = zstandard.ZstdDecompressor().decompress(data)
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def _numbered(src: DataFrame, model: str, block: int) -> DataFrame:
    """Rows of some documents of a block (keys, sizes, numbers) and, behind them, one row of its words (sizes, words, n)."""
    kind = src.schema["key"].dataType.simpleString()
    schema = f"block string, keys array<{kind}>, numbers binary, sizes binary, words binary, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, key_kind = segmenter(model), None
        name, held, table = uuid.uuid4().hex, 0, None

        def out(keys, numbers, sizes, words, n):
            keys = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), keys, pa.array([numbers], pa.binary()), pa.array([sizes], pa.binary()),
                 pa.array([words], pa.binary()), pa.array([n], pa.int64())],
                names=["block", "keys", "numbers", "sizes", "words", "n"])

        def some(keys, numbers):
            return out(keys, _squeeze(np.concatenate(numbers)), _squeeze(np.array([len(x) for x in numbers])), None, None)

        def close():
            return out(pa.nulls(0, key_kind), None, *_pack(list(table)), len(table))

        for batch in batches:
            key_kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                numbers, start = [], 0
                for i, data in enumerate(part.column(1).to_pylist()):
                    if table is None:
                        table = defaultdict()
                        table.default_factory = table.__len__
                    numbers.append(np.array(list(map(table.__getitem__, seg.words(data))), np.uint32))
                    held += len(data)
                    if held >= block:
                        yield some(part.column(0).slice(start, i + 1 - start), numbers)
                        yield close()
                        name, held, table = uuid.uuid4().hex, 0, None
                        numbers, start = [], i + 1
                if numbers:
                    yield some(part.column(0).slice(start), numbers)
        if table is not None:
            yield close()

    return src.mapInArrow(run, schema)


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", decoded: bool = False,
           block: int = BLOCK) -> DataFrame:
    """Per row: key and ``ids``, the sentencepiece ids of the whole text without begin or end.

    With ``decoded`` also the text that the library decodes from the ids.

    ``model`` is the path of the .model file on every machine. A null text is an empty one and has no ids.
    Every row keeps its own ids, so repeated rows and null keys need no rule; other
    columns are not read. A text longer than ``block`` is a block of its own. With a model whose pieces
    cross markers, or that rewrites texts before it cuts them, whole texts take the place of words.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    src = docs.select(F.col(f"`{key}`").alias("key"), text_bytes(F.col(f"`{text}`")).alias("body"))
    kind = src.schema["key"].dataType.simpleString()
    # written once: the names of blocks and the numbers of words hold for both uses below
    numbered = scratch.save_bucketed(_numbered(src, model, block), "block")
    words = numbered.where(F.col("n").isNotNull()).select("block", "sizes", "words", "n")
    buckets = min(BUCKETS, max(1, -(-(words.agg(F.sum("n")).first()[0] or 0) // WORDS)))

    def deal(batch: pa.RecordBatch) -> dict:
        cols = {c: [] for c in ("bucket", "block", "at", "sizes", "words")}
        for name, sizes, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            all_words = _unpack(sizes, data)
            h = np.fromiter(map(xxhash.xxh3_64_intdigest, all_words), np.uint64, len(all_words)) % np.uint64(buckets)
            order = np.argsort(h, kind="stable")
            edges = np.flatnonzero(np.diff(h[order])) + 1
            for at in np.split(order, edges) if len(order) else []:
                packed = _pack([all_words[i] for i in at.tolist()])
                for c, v in zip(cols, (int(h[at[0]]), name, _squeeze(np.diff(at, prepend=0)), *packed)):
                    cols[c].append(v)
        return cols

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come bucket by bucket; each distinct word of a bucket is segmented once."""
        seg, of, last = segmenter(model), {}, None
        for batch in batches:
            sizes, ids = [], []
            for bucket, lengths, data in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                if bucket != last:
                    of, last = {}, bucket
                mine = _unpack(lengths, data)
                new = [w for w in mine if w not in of]
                of.update(zip(new, [np.array(g, "<u4").tobytes() for g in seg.ids(new)]))
                got = [of[w] for w in mine]
                sizes.append(_squeeze(np.fromiter(map(len, got), np.uint32, len(got)) // 4))
                ids.append(_squeeze(np.frombuffer(b"".join(got), "<u4")))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())],
                                             names=["block", "at", "sizes", "ids"])

    dealt = map_arrow(words.select("block", "sizes", "words"),
                      "bucket bigint, block string, at binary, sizes binary, words binary", deal)
    answers = dealt.repartition("bucket").sortWithinPartitions("bucket") \
        .mapInArrow(answer, "block string, at binary, sizes binary, ids binary")

    def gather(mine: pa.Table, table: pa.Table) -> pa.Table:
        parts = [(np.cumsum(_swell(at).astype(np.int64)), _swell(s).astype(np.int64), _swell(i).astype(np.int32))
                 for at, s, i in zip(*(table[c].to_pylist() for c in ("at", "sizes", "ids")))]
        at, length, flat = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        size, start = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        size[at], start[at] = length, np.cumsum(length) - length
        keys = [x.values for x in mine["keys"].combine_chunks()] if len(mine) else []
        ids, ends, texts = [], [np.zeros(1, np.int64)], []
        for packed, words in zip(mine["numbers"].to_pylist(), mine["sizes"].to_pylist()):
            n, words = _swell(packed), _swell(words).astype(np.int64)
            long = size[n]
            begin = np.cumsum(long) - long
            got = flat[np.repeat(start[n] - begin, long) + np.arange(int(long.sum()))].astype(np.int32)
            last = np.r_[0, np.cumsum(long)][np.cumsum(words)]
            ids.append(got)
            ends.append(ends[-1][-1] + last)
            if decoded:
                sp = segmenter(model).sp
                texts += [sp.decode(got[a:b].tolist()) if b > a else "" for a, b in zip([0, *last.tolist()], last.tolist())]
        values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        cols = {"key": pa.concat_arrays(keys) if keys else pa.nulls(0, mine["keys"].type.value_type),
                "ids": pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(values, pa.int32()))}
        if decoded:
            cols["decoded"] = pa.array(texts, pa.string())
        return pa.table(cols)

    mine = numbered.where(F.col("n").isNull()).select("block", "keys", "numbers", "sizes")
    out = f"key {kind}, ids array<int>" + ", decoded string" * decoded
    return mine.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(gather, out).withColumnRenamed("key", key)


def decode(rows: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text that the library decodes from their ids; null ids: empty."""
    names = [c for c in rows.columns if c != out]
    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names] + [f"`{out}` string"])
    at = names.index(ids)

    def run(batch: pa.RecordBatch) -> dict:
        sp = segmenter(model).sp
        texts = [sp.decode(x) if x else "" for x in batch.column(at).to_pylist()]
        return {c: batch.column(i) for i, c in enumerate(names)} | {out: texts}

    return map_arrow(rows.select(*[F.col(f"`{c}`") for c in names]), schema, run)
