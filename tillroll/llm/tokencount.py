"""Token counts of a sentencepiece BPE model by rank-synchronous array merging.

Texts are cut into pre-tokens that no vocabulary piece can cross (a space ends
whatever stands before it, and a character that no longer piece holds stands alone). A
batch of pre-tokens is one ragged numpy array of symbols; in every round each
sequence applies its pair of lowest rank, all sequences at once, until no sequence has
a pair left; the surviving symbols are the tokens. Characters outside the
vocabulary count their UTF-8 bytes (byte fallback).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow

NEVER = np.int32(2**31 - 1)
SPACE = "▁"


class PairTable:
    """(left, right) -> rank of the merged piece, by open addressing in numpy."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(4 * len(left)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NEVER, np.int32)
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        todo = np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = key[free]          # of several for one slot, one stays
            self.ranks[slot[free]] = np.where(self.keys[slot[free]] == key[free], rank[free], self.ranks[slot[free]])
            won = self.keys[slot[todo]] == key[todo]
            self.ranks[slot[todo[won]]] = rank[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        out = np.full(len(key), NEVER, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        return out


class PieceCounter:
    """Counts the tokens of texts; one for each Python worker and model file."""

    CACHE = 300_000        # pre-tokens whose count is kept
    CACHED_LENGTH = 64
    GROUP = 1 << 21        # characters whose pre-tokens are held at once

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        special = {i for i in range(len(sp)) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        normal = [(sp.get_score(i), sp.id_to_piece(i)) for i in range(len(sp)) if i not in special]
        order = sorted(range(len(normal)), key=lambda i: -normal[i][0])
        self.pieces = [normal[i][1] for i in order]      # symbol number = rank of the piece
        number = {p: i for i, p in enumerate(self.pieces)}
        known = len(self.pieces)
        for p in list(self.pieces):                      # characters that only stand inside pieces
            for c in p:
                number.setdefault(c, len(number))
        left, right, rank = [], [], []
        inside = set()
        for p in self.pieces:
            if len(p) > 1:
                inside.update(p)
            for i in range(1, len(p)):
                if p[:i] in number and p[i:] in number:
                    left.append(number[p[:i]]), right.append(number[p[i:]]), rank.append(number[p])
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece of this model goes on after a space, so spaces do not cut its texts")
        self.table = PairTable(np.array(left), np.array(right), np.array(rank, np.int32))
        self.of_char = np.full(0x110000, -1, np.int32)
        for c, i in number.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.cost = np.ones(len(number), np.int64)       # tokens a surviving symbol makes
        for c, i in number.items():
            if i >= known:
                self.cost[i] = len(c.encode())
        self.newline_alone = "\n" not in inside
        self.newline_cost = 1
        self.cache: dict[str, int] = {}

    # --- pre-tokens ---------------------------------------------------------------

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, tokens of the newlines between them)."""
        if not text:
            return [], 0
        text = " " + text.replace(SPACE, " ")            # the model's dummy prefix
        if not self.newline_alone:
            return self._spaced(text), 0
        lines = text.split("\n")
        out = []
        for line in lines:
            out += self._spaced(line)
        return out, (len(lines) - 1) * self.newline_cost

    @staticmethod
    def _spaced(line: str) -> list[str]:
        first, *words = line.split(" ")
        out = [first] if first else []
        if "" not in words:
            out += [SPACE + w for w in words]
            return out
        run = ""
        for w in words:
            run += SPACE
            if w:
                out.append(run + w)
                run = ""
        if run:
            out.append(run)
        return out

    # --- merging ----------------------------------------------------------------

    def merge(self, seqs: list[str]) -> np.ndarray:
        """Tokens of each (non-empty) sequence."""
        code = np.frombuffer("".join(seqs).encode("utf-32-le", "surrogatepass"), "<u4")
        sym = self.of_char[code]
        size = np.array([len(s) for s in seqs], np.int64)
        total = np.zeros(len(seqs), np.int64)
        of = np.repeat(np.arange(len(seqs)), size)
        outside = sym < 0
        if outside.any():                                # byte fallback
            c = code[outside]
            width = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
            total += np.bincount(of[outside], width, len(seqs)).astype(np.int64)
        rank = self._ranks(sym, of)
        while len(sym):
            start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            best = np.minimum.reduceat(rank, start)
            size = np.diff(np.r_[start, len(sym)])
            done = np.repeat(best == NEVER, size)
            if done.any():
                own = sym[done]
                total += np.bincount(of[done], np.where(own >= 0, self.cost[np.maximum(own, 0)], 0), len(seqs)).astype(np.int64)
                sym, of, rank = sym[~done], of[~done], rank[~done]
                size, best = size[best != NEVER], best[best != NEVER]
                if not len(sym):
                    break
            lowest = np.repeat(best, size)
            hit = np.flatnonzero(rank == lowest)
            # of overlapping pairs every other one, from the left
            begins = np.r_[True, np.diff(hit) > 1]
            at = np.arange(len(hit))
            hit = hit[(at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0]
            new = self._apply(sym, of, rank, hit, lowest)
            # a merge may open a pair of still lower rank, which then comes before
            # the merges to its right: such sequences take their leftmost merge only
            early = new[2] < new[3]
            if early.any():
                again = np.zeros(of[-1] + 1, bool)
                again[new[1][early]] = True
                first = np.r_[True, of[hit][1:] != of[hit][:-1]]
                only = hit[first | ~again[of[hit]]]
                if len(only) < len(hit):
                    new = self._apply(sym, of, rank, only, lowest)
            sym, of, rank = new[:3]
        return total

    def _ranks(self, sym: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Of the pair that begins at each symbol; NEVER for the last of a sequence."""
        out = np.full(len(sym), NEVER, np.int32)
        ok = np.flatnonzero((of[1:] == of[:-1]) & (sym[1:] >= 0) & (sym[:-1] >= 0))
        out[ok] = self.table.get(sym[ok], sym[ok + 1])
        return out

    def _apply(self, sym, of, rank, hit, lowest):
        sym = sym.copy()
        sym[hit] = lowest[hit]                           # the symbol of a piece is its rank
        stay = np.ones(len(sym), bool)
        stay[hit + 1] = False
        at = hit - np.arange(len(hit))                   # where the merged symbols are then
        sym, of, rank, lowest = sym[stay], of[stay], rank[stay], lowest[stay]
        touched = np.unique(np.r_[at, at[at > 0] - 1])
        rank[touched] = NEVER
        ok = touched[touched + 1 < len(sym)]
        ok = ok[(of[ok] == of[ok + 1]) & (sym[ok] >= 0) & (sym[ok + 1] >= 0)]
        rank[ok] = self.table.get(sym[ok], sym[ok + 1])
        return sym, of, rank, lowest

    # --- texts ------------------------------------------------------------------

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        i = 0
        while i < len(texts):
            held, group = 0, []
            while i < len(texts) and held < self.GROUP:
                group.append((i, *self.pre_tokens(texts[i])))
                held += len(texts[i])
                i += 1
            new = set()
            for _, tokens, _ in group:
                new.update(tokens)
            if len(self.cache) + len(new) > self.CACHE:
                self.cache.clear()
            new = [t for t in new if t not in self.cache]
            counts = self.cache
            for b in range(0, len(new), 50_000):
                part = new[b:b + 50_000]
                counts.update(zip(part, self.merge(part).tolist()))
            for at, tokens, newlines in group:
                out[at] = newlines + sum(map(counts.__getitem__, tokens))
            for t in new:
                if len(t) > self.CACHED_LENGTH:
                    del counts[t]
        return out


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes (UTF-8), n_tokens, over_limit.

    ``model`` is the path of the .model file on every machine. A null text is an empty
    one and has no token. Rows are counted one by one, so repeated
    rows and null keys need no rule; other columns are not read.
    """
    src = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = src.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        import pyarrow.compute as pc

        n = counter(model).count(batch.column(1).to_pylist())
        return {"key": batch.column(0), "n_bytes": pc.binary_length(batch.column(1)).cast(pa.int64()),
                "n_tokens": n, "over_limit": n > limit}

    return map_arrow(src, f"key {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", run) \
        .withColumnRenamed("key", key)
