"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash of 16 bytes cuts texts at white space where the hash has a given
form, so the cuts follow the content and texts that share a passage share its
chunks. A chunk that occurs more than once in the corpus is encoded once, by one
owner, and its ids are joined to every document that uses it; chunks that occur once
are encoded where they are. Overlong chunks without such a place are cut
anywhere, even inside a word.

At each join of two chunks a window over the pieces around it is encoded anew from
the text itself. If that differs from what the chunks gave, the window's ids
replace theirs, and the window widens until its outermost pieces, which lie behind
white space, agree exactly with the chunks' encoding.
"""

from __future__ import annotations

import os
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import bloom, blocks_for, split
from tillroll.llm.common import SLICE, Scratch, WindowHash, map_arrow, mix64, row_key, text_bytes

ROLL = 16             # bytes the rolling hash sees
ONE_IN = 128          # of the white-space places, one in so many is a cut
SHORTEST, LONGEST = 128, 8192
_HASH = WindowHash(0x2545F4914F6CDD1D)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TAIL = b"!\"#$%&()*+,-./:;=?@[]^_`{}~"      # ASCII punctuation but the apostrophe and what special tokens are made of


def cuts(data: bytes) -> list[int]:
    """Offsets inside ``data`` at which a new chunk begins."""
    n = len(data)
    if n <= SHORTEST:
        return []
    byte = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(_SPACE[byte[ROLL - 1:]]) + ROLL      # just behind a space
    out, last = [], 0
    if len(at):
        prefix = _HASH.prefix(byte.astype(np.uint64) + np.uint64(1))
        h = mix64(_HASH.spans(prefix, at - ROLL, at))
        at = at[h % np.uint64(ONE_IN) == 0].tolist()
    for c in chain(at, [n]):
        while c - last > LONGEST:
            last += LONGEST
            while last > 0 and data[last] & 0xC0 == 0x80:    # not inside a character
                last -= 1
            out.append(last)
        if c - last >= SHORTEST and c < n:
            out.append(c)
            last = c
    return out


def pieces(data: bytes, at: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``, words that a cut divides counted as several."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~_SPACE[np.frombuffer(data, np.uint8)]
    starts = np.flatnonzero(word[1:] & ~word[:-1])
    ends = np.flatnonzero(word[:-1] & ~word[1:])
    inside = np.array([c for c in at if word[c] and word[c + 1]], np.int64)
    if len(inside):
        starts, ends = np.sort(np.r_[starts, inside]), np.sort(np.r_[ends, inside])
    return starts, ends


class Encoder:
    """One for each Python worker and tokenizer file; words' ids are kept in a bounded cache."""

    CACHE = 300_000       # words whose ids are kept from one group of texts to the next, about
    CACHED_LENGTH = 64
    JOINED = 256          # new words the library gets as one text, a special token between them
    TOGETHER = 4 << 20    # bytes of text whose words are looked up together

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.kind = np.dtype("<u2" if self.tok.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4")
        if hasattr(self.tok.model, "_resize_cache"):
            self.tok.model._resize_cache(0)              # it is asked for words that are not in the cache here
        self.cache: dict[bytes, bytes] = {}
        self.passing: list[bytes] = []     # long words, kept until the next group only
        self.vocabulary = None
        self.divides = self._divides()
        plain = [(i, t.content) for i, t in self.tok.get_added_tokens_decoder().items()
                 if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.between = (plain[-1][0], plain[-1][1].encode()) if plain else None

    def direct(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as packed numbers, straight from the library."""
        got = self.tok.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in got]

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. The library splits at special tokens before all else, so words may share a text."""
        if self.between is None:
            return self.direct(words)
        number, sign = self.between
        alone = [i for i, w in enumerate(words) if b"<" in w or len(w) > self.CACHED_LENGTH or sign[:1] in w]
        single = dict(zip(alone, self.direct([words[i] for i in alone])))
        rest = [w for i, w in enumerate(words) if i not in single] if single else words
        texts = [sign.join(rest[i:i + self.JOINED]) for i in range(0, len(rest), self.JOINED)]
        got: list[bytes] = []
        for e in self.tok.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False):
            ids = np.array(e.ids, self.kind)
            ends = np.flatnonzero(ids == number) * self.kind.itemsize
            packed, begin = ids.tobytes(), 0
            for end in [*ends.tolist(), len(packed)]:
                got.append(packed[begin:end])
                begin = end + self.kind.itemsize
        if not single:
            return got
        rest_ids = iter(got)
        return [single[i] if i in single else next(rest_ids) for i in range(len(words))]

    def _divides(self) -> bool:
        """Whether the tokenizer sees a letter and ASCII punctuation behind it as different pre-tokens and no ASCII case."""
        return all(self.direct([w]) == [b"".join(self.direct([s, t]))] for w, s, t in (
            (b"AbCd.", b"abcd", b"."), (b"x9Zq,!?", b"x9zq", b",!?"), (b"don\'T$$", b"don\'t", b"$$"), (b"q%%%", b"q", b"%%%")))

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of all ``words``.

        Punctuation at a word's end is a pre-token of its own and ASCII letters count in one case,
        so words meet in the cache by what is left without them.
        """
        cache = self.cache
        for w in self.passing:
            del cache[w]
        if len(cache) > self.CACHE:        # the words seen first are the frequent ones: they stay
            cache = self.cache = dict(islice(cache.items(), self.CACHE // 2))
        parted = []
        for w in words:
            if w in cache:
                continue
            stem = w
            if self.divides and b"<" not in w:
                cut = w.rstrip(_TAIL)
                if cut and cut[-1:].isalnum():
                    stem = cut
                if w.isascii():
                    stem = stem.lower()
            parted.append((w, stem, w[len(stem):]))
        new = {p for x in parted for p in x[1:] if p and p not in cache}
        cache.update(zip(new, self.words(list(new))))
        self.passing = [w for w in new if len(w) > self.CACHED_LENGTH or len(cache[w]) > self.CACHED_LENGTH]
        for w, stem, tail in parted:
            if w not in new:
                cache[w] = cache[stem] + cache[tail] if tail else cache[stem]
                if len(w) > self.CACHED_LENGTH or len(cache[w]) > self.CACHED_LENGTH:
                    self.passing.append(w)
        return cache

    def assemble(self, bodies: list[bytes], known: list[dict[int, bytes]]) -> list[bytes]:
        """Ids of whole texts; ``known``: for each text, ids of chunks encoded elsewhere, by chunk number."""
        out: list[bytes] = []
        group, held = [], 0
        for i, body in enumerate(bodies):
            group.append((body, known[i]))
            held += len(body)
            if held > self.TOGETHER:
                out += self._assemble(group)
                group, held = [], 0
        return out + self._assemble(group)

    def _assemble(self, group) -> list[bytes]:
        plans, words = [], set()
        for body, known in group:
            at = cuts(body)
            bounds = [0, *at, len(body)]
            chunks = [None if j in known else body[bounds[j]:bounds[j + 1]].split() for j in range(len(bounds) - 1)]
            joins = []
            if at:
                starts, ends = pieces(body, at)
                for c in at:
                    p = int(np.searchsorted(starts, c))       # the first piece behind the cut
                    lo, hi = max(0, p - 2), min(len(starts), p + 2)
                    joins.append((lo, hi))
                    words.update(body[starts[q]:ends[q]] for q in range(lo, hi))
            else:
                starts = ends = None
            for c in chunks:
                if c is not None:
                    words.update(c)
            plans.append((body, chunks, known, starts, ends, joins, at))
        ids = self.learn(words)
        windows, owner = [], []
        for d, (body, _, _, starts, ends, joins, _) in enumerate(plans):
            for lo, hi in joins:
                if hi > lo:
                    windows.append(body[starts[lo]:ends[hi - 1]])
                    owner.append((d, lo, hi))
        wrong: dict[int, list[tuple[int, int]]] = {}
        for (d, lo, hi), got in zip(owner, self.direct(windows)):
            body, _, _, starts, ends, _, _ = plans[d]
            if got != b"".join([ids[body[starts[q]:ends[q]]] for q in range(lo, hi)]):
                wrong.setdefault(d, []).append((lo, hi))
        out = []
        for d, (body, chunks, known, starts, ends, _, at) in enumerate(plans):
            if d in wrong:
                out.append(self._repair(body, starts, ends, wrong[d], at, chunks, known, ids))
            else:
                out.append(b"".join([known[j] if c is None else b"".join([ids[w] for w in c])
                                     for j, c in enumerate(chunks)]))
        return out

    def _repair(self, body, starts, ends, wrong, at, chunks, known, ids) -> bytes:
        """The text's ids where windows disagree: their spans are encoded anew, widened until the rims agree."""
        n = len(starts)
        spaced = np.r_[True, starts[1:] > ends[:-1], True]     # white space before piece q
        extra: dict[bytes, bytes] = {}

        def of(q: int) -> bytes:
            w = body[starts[q]:ends[q]]
            if w in ids:
                return ids[w]
            if w not in extra:
                extra[w] = self.direct([w])[0]
            return extra[w]

        todo, spans = sorted(wrong), []
        while todo:
            lo, hi = todo.pop(0)
            while todo and todo[0][0] <= hi:                   # windows that meet are one
                hi = max(hi, todo.pop(0)[1])
            while True:
                while not spaced[lo]:
                    lo -= 1
                while not spaced[hi]:
                    hi += 1
                left, right = lo, hi
                if lo > 0:                                     # a rim piece on either side
                    left -= 1
                    while not spaced[left]:
                        left -= 1
                if hi < n:
                    right += 1
                    while not spaced[right]:
                        right += 1
                core = self.direct([body[starts[lo]:ends[hi - 1]]])[0]
                rims = (self.direct([body[starts[left]:ends[lo - 1]]])[0] if left < lo else b"",
                        self.direct([body[starts[hi]:ends[right - 1]]])[0] if right > hi else b"")
                if self.direct([body[starts[left]:ends[right - 1]]])[0] == rims[0] + core + rims[1]:
                    break
                lo, hi = left, right
            if spans and spans[-1][1] >= lo:
                todo.insert(0, (spans[-1][0], hi))
                spans.pop()
            else:
                spans.append((lo, hi, core))
        out, q = [], 0
        bounds = [0, *at, len(body)]
        first = np.searchsorted(starts, bounds)                # pieces by chunk
        for lo, hi, core in [*spans, (n, n, b"")]:
            while q < lo:
                j = int(np.searchsorted(first, q, side="right")) - 1
                end = int(first[j + 1])
                if q == first[j] and end <= lo:                # a whole chunk stands
                    out.append(known[j] if chunks[j] is None else b"".join([ids[w] for w in chunks[j]]))
                    q = end
                else:
                    out.append(of(q))
                    q += 1
            out.append(core)
            q = max(q, hi)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        if self.tok.decoder is not None:
            return self.tok.decode(ids, skip_special_tokens=False)
        if self.vocabulary is None:
            size = self.tok.get_vocab_size(with_added_tokens=True)
            self.vocabulary = [self.tok.id_to_token(i) for i in range(size)]
        return " ".join([self.vocabulary[i] for i in ids])     # what the library does without a decoder


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _split(rows: DataFrame, keys: DataFrame, row) -> tuple[DataFrame, DataFrame]:
    blocks = blocks_for(keys.count())
    return split(rows, bloom(keys, blocks), blocks, row)


def _packed(src: DataFrame) -> DataFrame:
    """key, k, th and the text as a zstd frame, which halves what a join moves."""
    def run(batch: pa.RecordBatch) -> dict:
        z = zstandard.ZstdCompressor(level=3)
        return {"key": batch.column(0), "k": batch.column(1), "th": batch.column(2),
                "body": [z.compress(b) for b in batch.column(3).to_pylist()]}
    return map_arrow(src.select("key", "k", "th", "body"),
                     f"key {src.schema['key'].dataType.simpleString()}, k string, th binary, body binary", run)


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """Per row: key and ``ids``, the ids of the whole text as the library gives them without added special tokens.

    With ``decoded`` also the text that :func:`decode` makes of the ids, by the same worker.

    ``tokenizer`` is the path of a tokenizers .json file on every machine whose pre-tokens do
    not cross white space. A null text is an empty one and has no ids. Rows with equal
    key and text are encoded alike; null keys are a key like any other.
    """
    scratch = Scratch(docs.sparkSession)
    src = docs.select(
        F.col(f"`{key}`").alias("key"), *row_key(key, text), text_bytes(F.col(f"`{text}`")).alias("body"))

    def chunk(batch: pa.RecordBatch) -> dict:
        h, row, pos = [], [], []
        for i, body in enumerate(batch.column(2).to_pylist()):
            bounds = [0, *cuts(body), len(body)] if body else [0]
            for j in range(len(bounds) - 1):
                h.append(xxhash.xxh3_128_digest(body[bounds[j]:bounds[j + 1]]))
                row.append(i)
                pos.append(j)
        h = np.frombuffer(b"".join(h), np.int64).reshape(-1, 2)
        row = pa.array(row, pa.int64())
        return {"h1": h[:, 0].copy(), "h2": h[:, 1].copy(), "k": batch.column(0).take(row),
                "th": batch.column(1).take(row), "pos": pa.array(pos, pa.int32())}

    chunks = scratch.save(map_arrow(src.select("k", "th", "body"), "h1 bigint, h2 bigint, k string, th binary, pos int", chunk))
    shared = scratch.save(
        chunks.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.min(F.struct("k", "th", "pos")).alias("one"))
        .where("c > 1").select("h1", "h2", "one"))
    # one row for each use even where whole rows repeat
    uses = scratch.save(chunks.join(shared.select("h1", "h2"), ["h1", "h2"]).dropDuplicates(["k", "th", "pos"]))
    scratch.drop(chunks)

    # A document's text is shuffled only if it shares a chunk, and once more if it owns one: Bloom
    # filters of bounded size keep most others out, and whom they let through in vain the joins handle.
    row = F.concat(F.col("k").cast("binary"), F.col("th"))
    body = src.select("key", "k", "th", "body")
    shares, alone = _split(body, uses.select(row.alias("key")).distinct(), row)
    owning, _ = _split(body, shared.select(F.concat(F.col("one.k").cast("binary"), F.col("one.th")).alias("key")).distinct(), row)
    owned = (shared.select("one.k", "one.th", F.struct("one.pos", "h1", "h2").alias("x"))
             .groupBy("k", "th").agg(F.collect_list("x").alias("own")))
    # of equal rows one is the owner
    owners = _packed(owning).select("k", "th", "body").dropDuplicates(["k", "th"]).join(owned, ["k", "th"]).select("body", "own")

    def own_chunks(batch: pa.RecordBatch) -> dict:
        e, z = encoder(tokenizer), zstandard.ZstdDecompressor()
        texts, h1, h2 = [], [], []
        for body, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            body = z.decompress(body)
            bounds = [0, *cuts(body), len(body)]
            for x in own:
                texts.append(body[bounds[x["pos"]]:bounds[x["pos"] + 1]].split())
                h1.append(x["h1"]), h2.append(x["h2"])
        ids = e.learn(set(chain.from_iterable(texts)))
        return {"h1": h1, "h2": h2, "ids": [b"".join([ids[w] for w in t]) for t in texts]}

    # written, so that the join below is between scans and AQE may split the partition of a hot chunk
    encoded = scratch.save(map_arrow(owners, "h1 bigint, h2 bigint, ids binary", own_chunks).dropDuplicates(["h1", "h2"]))
    given = (uses.join(encoded, ["h1", "h2"]).groupBy("k", "th")
             .agg(F.collect_list(F.struct("pos", "ids")).alias("given")))
    joined = _packed(shares).join(given, ["k", "th"], "left").select("key", "body", "given")
    kind = src.schema["key"].dataType.simpleString()

    def whole(batch: pa.RecordBatch) -> dict:
        e, z = encoder(tokenizer), zstandard.ZstdDecompressor()
        known = [{x["pos"]: x["ids"] for x in g or []} for g in batch.column(2).to_pylist()]
        return rows(batch, e, [z.decompress(b) for b in batch.column(1).to_pylist()], known)

    def by_itself(batch: pa.RecordBatch) -> dict:
        return rows(batch, encoder(tokenizer), batch.column(1).to_pylist(), [{}] * batch.num_rows)

    def rows(batch: pa.RecordBatch, e: Encoder, bodies: list[bytes], known: list[dict]) -> dict:
        packed = e.assemble(bodies, known)
        size = np.array([len(p) // e.kind.itemsize for p in packed], np.int64)
        values = np.frombuffer(b"".join(packed), e.kind).astype(np.int32)
        offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
        out = {"key": batch.column(0), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}
        if decoded:
            out["decoded"] = [e.decode(np.frombuffer(p, e.kind).tolist()) for p in packed]
        return out

    out = f"key {kind}, ids array<int>" + ", decoded string" * decoded
    return map_arrow(joined, out, whole, sized=1, size=SLICE // 3).unionByName(     # packed texts, about a third
        map_arrow(alone.select("key", "body"), out, by_itself, sized=1)).withColumnRenamed("key", key)


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids as the library decodes them, special tokens included; null ids: empty."""
    names = [c for c in rows.columns if c != out]
    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names] + [f"`{out}` string"])
    at = names.index(ids)

    def run(batch: pa.RecordBatch) -> dict:
        e = encoder(tokenizer)
        texts = [e.decode(x.values.to_pylist() if x.is_valid else []) for x in batch.column(at)]
        return {c: batch.column(i) for i, c in enumerate(names)} | {out: texts}

    return map_arrow(rows.select(*names), schema, run)
