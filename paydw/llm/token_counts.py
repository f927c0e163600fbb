"""Operator 10: token counts by rank-synchronous array merging.

Pre-tokens of a batch of texts are held as one ragged numpy array of symbols.
Every round finds each sequence's lowest-rank pair and merges it in all
sequences at once; sequences without a mergeable pair leave the array, and the
symbols that survive are counted. A pre-token is merged once per task and then
counted from a bounded table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.llm.common import bounded_batches

SPACE = "▁"
NO_PAIR = np.int32(2**31 - 1)


class Merges:
    """Pair table of a BPE piece model: which neighbours merge into what, and in which order."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        """``pieces``: (text, score, kind) by id; kind 1 is a normal piece, others never merge."""
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == 1}
        scores = sorted({s for p, s, kind in pieces if kind == 1 and len(p) > 1}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        self.width = len(pieces) + 1  # the last id stands for a character without a piece
        pairs = {}
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = (rank[pieces[i][1]], i)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int32)
        # a piece is settled if whatever it is merged into comes later: then all its places in a
        # sequence merge in one round, as they would one after the other
        own, least = np.full(self.width, NO_PAIR), np.full(self.width, NO_PAIR)
        own[self.made] = self.ranks
        for part in (self.keys // self.width, self.keys % self.width):
            np.minimum.at(least, part, self.ranks)
        self.settled = least > own
        # where a piece cannot reach over: before a space mark that follows another character,
        # and around characters that are part of no longer piece
        inner = {c for p in self.ids if len(p) > 1 for c in p}
        joined = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        alone = "".join(c for c in "\n\t\r" if c not in inner)
        if joined:
            self.split = re.compile(r"(?s).+")
        else:
            self.split = re.compile(f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone
                                    else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    @classmethod
    def of_model(cls, path: str) -> Merges:
        """The pair table of a sentencepiece BPE model file."""
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        return cls([(p.piece, p.score, p.type) for p in model.pieces])

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; rank ``NO_PAIR`` where nothing merges."""
        want = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        hit = self.keys[at] == want
        return np.where(hit, self.ranks[at], NO_PAIR), np.where(hit, self.made[at], -1)

    def count(self, words: list[str]) -> np.ndarray:
        """Number of tokens of each word."""
        out = np.zeros(len(words), dtype=np.int64)
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        chars, back = np.unique(points, return_inverse=True)
        known = np.array([self.ids.get(chr(c), self.width - 1) for c in chars], dtype=np.int64)
        size = np.array([1 if k < self.width - 1 else len(chr(c).encode("utf-8", "replace"))
                         for c, k in zip(chars.tolist(), known.tolist(), strict=True)], dtype=np.int64)
        sym, cost = known[back], size[back]
        seq = np.repeat(np.arange(len(words)), lens)
        rank, made = self._pairs(sym, seq)
        while len(sym):
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            length = np.diff(np.r_[first, len(seq)])
            best = np.minimum.reduceat(rank, first)
            live = best < NO_PAIR
            if not live.all():  # finished sequences leave with what is left of them
                out[seq[first[~live]]] = np.add.reduceat(cost, first)[~live]
                stay = np.repeat(live, length)
                sym, cost, seq, rank, made = sym[stay], cost[stay], seq[stay], rank[stay], made[stay]
                best, length = best[live], length[live]
                if not len(sym):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, length))
            new = np.r_[True, seq[hits[1:]] != seq[hits[:-1]]]
            begins = new | np.r_[True, hits[1:] != hits[:-1] + 1]  # of neighbouring pairs every second one merges
            place = np.arange(len(hits)) - np.maximum.accumulate(np.where(begins, np.arange(len(hits)), 0))
            hits = hits[np.where(self.settled[made[hits]], place % 2 == 0, new)]  # else only the leftmost
            sym[hits] = made[hits]
            stay = np.ones(len(sym), dtype=bool)
            stay[hits + 1] = False
            at = hits - np.arange(len(hits))  # where the merged symbols are afterwards
            sym, cost, seq, rank, made = sym[stay], cost[stay], seq[stay], rank[stay], made[stay]
            for i in (at, at[at > 0] - 1):
                rank[i], made[i] = self._pairs(sym, seq, i)
        return out

    def _pairs(self, sym, seq, at=None):
        """Rank and merged id of the pairs that begin at ``at`` (all by default)."""
        at = np.arange(len(sym)) if at is None else at
        nxt = np.minimum(at + 1, max(len(sym) - 1, 0))
        rank, made = self.look_up(sym[at], sym[nxt])
        pair = (nxt > at) & (seq[nxt] == seq[at])
        return np.where(pair, rank, NO_PAIR), made


def text_counts(merges: Merges, texts: list[str], table: dict[str, int], most: int) -> list[int]:
    """Tokens of each text. ``table`` keeps at most about ``most`` characters' worth of pre-tokens."""
    split = merges.split.findall
    spans = [split(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
    fresh = list({w for words in spans for w in words if w not in table})
    for i in range(0, len(fresh), 200_000):
        part = fresh[i:i + 200_000]
        table.update(zip(part, merges.count(part).tolist(), strict=True))
    get = table.__getitem__
    out = [sum(map(get, words)) for words in spans]
    if sum(map(len, fresh)) > most or len(table) > most // 10:
        table.clear()
    return out


def slices(texts: list[str], limit: int):
    """Neighbouring texts in groups of about ``limit`` characters, each text whole."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text", buffer_chars: int = 4_000_000) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``model``: path of a sentencepiece BPE model, readable on every executor.
    A null text counts as empty and has 0 tokens; null ids pass through;
    repeated rows give repeated results; other columns are ignored. Memory of a
    worker is bounded by ``buffer_chars`` plus the longest single text.
    """
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        merges, table = Merges.of_model(model), {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = []
            for i, j in slices(texts, buffer_chars):
                counts += text_counts(merges, texts[i:j], table, buffer_chars)
            sizes = [len(t.encode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return narrow.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
