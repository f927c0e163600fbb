"""Operator 7: language identification by a byte convolutional network.

Windows of a fixed number of bytes pass through filters of several widths over
byte embeddings, max pooling and a softmax. The network is trained in numpy on
a bounded sample of labelled windows and applied to every window of every text;
a text's scores are the mean over its windows, weighted by their bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.llm.common import bounded_batches

UNKNOWN = "und"
WINDOW = 256  # bytes
# Fixed value: a Unicode letter.
LETTER = r"\p{L}"


@dataclass
class ByteNet:
    """Filters as one table a width and offset: ``tables[w][k][byte]`` is what a byte adds at place k."""

    langs: list[str]
    tables: list[list[np.ndarray]]  # per width: per offset: (257, filters); row 256 is padding
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(windows, WINDOW) byte values, 256 where the text has ended -> (windows, languages)."""
        z = np.concatenate(self._pooled_by_pairs(windows), axis=1) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def _pooled_by_pairs(self, windows):
        """As ``_pooled``, with two neighbouring offsets looked up at once in a table of byte pairs."""
        if not hasattr(self, "_pairs"):
            self._pairs = [[(k, (t[k][:, None] + t[k + 1][None]).reshape(257 * 257, -1)) if k + 1 < len(t) else (k, t[k])
                            for k in range(0, len(t), 2)] for t in self.tables]
        two = windows[:, :-1].astype(np.int32) * 257 + windows[:, 1:]
        pooled = []
        for tables, bias, single in zip(self._pairs, self.bias, self.tables, strict=True):
            n, h = windows.shape[1] - len(single) + 1, None
            for k, table in tables:
                part = np.take(table, (two if len(table) > 257 else windows)[:, k:k + n], axis=0)
                h = part if h is None else np.add(h, part, out=h)
            pooled.append(np.maximum(h.max(axis=1) + bias, 0))
        return pooled

    def _pooled(self, windows):
        pooled, places = [], []
        for tables, bias in zip(self.tables, self.bias, strict=True):
            n = windows.shape[1] - len(tables) + 1
            h = np.take(tables[0], windows[:, :n], axis=0)
            for k in range(1, len(tables)):
                h += np.take(tables[k], windows[:, k:k + n], axis=0)
            pooled.append(np.maximum(h.max(axis=1) + bias, 0))
            places.append(h)
        return pooled, places


def train(texts: list[bytes], langs: list[str], widths=(2, 3, 4), filters: int = 16, dims: int = 8,
          epochs: int = 8, batch: int = 64, rate: float = 0.004, seed: int = 7) -> ByteNet:
    """Fit the network on labelled windows by Adam; the order of equal inputs does not matter."""
    names = sorted(set(langs))
    order = sorted(range(len(texts)), key=lambda i: (texts[i], langs[i]))
    x = padded([texts[i] for i in order])
    y = np.array([names.index(langs[i]) for i in order])
    rng = np.random.default_rng(seed)
    f32 = np.float32
    p = {"e": rng.normal(0, 0.5, (257, dims)).astype(f32)}
    p["e"][256] = 0
    for w in widths:
        p[f"f{w}"] = rng.normal(0, (w * dims) ** -0.5, (w, dims, filters)).astype(f32)
        p[f"b{w}"] = np.zeros(filters, f32)
    p["o"] = rng.normal(0, (filters * len(widths)) ** -0.5, (filters * len(widths), len(names))).astype(f32)
    p["ob"] = np.zeros(len(names), f32)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    weight = (len(y) / np.maximum(np.bincount(y, minlength=len(names)), 1) / len(names)).astype(f32)

    def net():
        return ByteNet(names, [[p["e"] @ p[f"f{w}"][k] for k in range(w)] for w in widths],
                       [p[f"b{w}"] for w in widths], p["o"], p["ob"])

    step = 0
    for _ in range(epochs):
        mixed = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            at = mixed[lo:lo + batch]
            xb, yb, model = x[at], y[at], net()
            pooled, places = model._pooled(xb)
            h = np.concatenate(pooled, axis=1)
            z = h @ p["o"] + p["ob"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            d = z / z.sum(axis=1, keepdims=True)
            d[np.arange(len(at)), yb] -= 1
            d *= (weight[yb] / len(at))[:, None]
            g = {"o": h.T @ d, "ob": d.sum(axis=0), "e": np.zeros_like(p["e"])}
            dh = (d @ p["o"].T) * (h > 0)
            for i, w in enumerate(widths):
                part = dh[:, i * filters:(i + 1) * filters]
                best = places[i].argmax(axis=1)  # (batch, filters): the place that won the pool
                g[f"b{w}"] = part.sum(axis=0)
                g[f"f{w}"] = np.zeros_like(p[f"f{w}"])
                for k in range(w):
                    byte = xb[np.arange(len(at))[:, None], best + k]
                    g[f"f{w}"][k] = np.einsum("bfd,bf->df", p["e"][byte], part)
                    np.add.at(g["e"], byte, part[:, :, None] * p[f"f{w}"][k].T[None])
            g["e"][256] = 0
            step += 1
            for k, v in g.items():
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.999 * s[k] + 0.001 * v * v
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9 ** step)) /
                        (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(f32)
    return net()


def padded(texts: list[bytes]) -> np.ndarray:
    """Windows as rows of byte values, 256 behind the end."""
    out = np.full((len(texts), WINDOW), 256, dtype=np.int16)
    for i, t in enumerate(texts):
        b = np.frombuffer(t[:WINDOW], dtype=np.uint8)
        out[i, :len(b)] = b
    return out


def sample_windows(docs: DataFrame, most: int = 4000, windows: int = 4, lang_col: str = "lang",
                   text_col: str = "text", id_col: str = "doc_id") -> list[tuple[bytes, str]]:
    """About ``most`` labelled texts, evenly over the languages, each by ``windows`` of its windows.

    This bounded sample is all that is fitted: ``most * windows * 256`` bytes
    reach the driver. A document is in the sample if the hash of its id and
    text is below its language's share, so reruns and other layouts give the
    same sample; documents without an id are told apart by their texts, and
    rows that are equal in id and text are drawn together and count once. Of
    more than ``most`` languages those with the most texts are learned.
    """
    known = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    counts = known.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(most).collect()
    shares = {r["lang"]: min(1.0, most / len(counts) / r["count"]) for r in counts}
    if not shares:
        return []
    rate = F.coalesce(*[F.when(F.col(lang_col) == k, F.lit(v)) for k, v in sorted(shares.items())], F.lit(0.0))
    own = F.xxhash64(F.lit("sample"), F.col(id_col), F.col(text_col))
    unit = F.pmod(own, F.lit(1 << 30)) / float(1 << 30)
    body = F.encode(F.col(text_col), "UTF-8")
    n = F.octet_length(text_col)
    starts = [F.lit(1)] + [(F.pmod(F.xxhash64(F.lit(k), F.col(id_col)),
                                   F.greatest(n - WINDOW, F.lit(1)).cast("long")) + 1).cast("int")
                           for k in range(1, windows)]
    rows = known.where(unit < rate).select(
        own.alias("own"), F.col(lang_col).alias("lang"),
        F.array_distinct(F.array(*[F.substring(body, s, WINDOW) for s in starts])).alias("parts")) \
        .groupBy("own", "lang").agg(F.first("parts").alias("parts"))
    return [(bytes(b), r["lang"]) for r in rows.toLocalIterator() for b in r["parts"]]


def fit(docs: DataFrame, most: int = 4000, **columns) -> ByteNet | None:
    """A network fitted on a bounded sample of the labelled rows of ``docs``; None without any."""
    sample = sample_windows(docs, most, **columns)
    return train([b for b, _ in sample], [k for _, k in sample]) if sample else None


def text_scores(net: ByteNet, texts: list[str], group: int = 256) -> np.ndarray:
    """Mean probabilities (texts, languages) over all windows of each text."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    counts = np.array([max(1, -(-len(b) // WINDOW)) for b in raw])
    owner = np.repeat(np.arange(len(raw)), counts)
    total, sums, done = np.zeros(len(raw)), np.zeros((len(raw), len(net.langs))), 0
    flat = np.full(int(counts.sum()) * WINDOW, 256, dtype=np.int16)
    for i, b in zip((np.r_[0, np.cumsum(counts)[:-1]] * WINDOW).tolist(), raw, strict=True):
        flat[i:i + len(b)] = np.frombuffer(b, dtype=np.uint8)
    flat = flat.reshape(-1, WINDOW)
    while done < len(flat):
        part = flat[done:done + group]
        filled = (part < 256).sum(axis=1)
        np.add.at(sums, owner[done:done + group], net.probabilities(part) * filled[:, None])
        np.add.at(total, owner[done:done + group], filled)
        done += group
    return sums / np.maximum(total, 1)[:, None]


def predict(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text",
            passing: tuple[str, ...] = (), buffer_chars: int = 1_000_000) -> DataFrame:
    """``doc_id, <passing>, lang_pred, score`` for every row of ``docs``.

    Only the text is read for a prediction. ``und`` with score 0 where the text
    is null or has no letter, or where nothing was learned; ties go to the
    smaller language name. Null ids and repeated rows pass through. A worker
    holds the windows of about ``buffer_chars`` characters at once, or of one text.
    """
    from paydw.llm.token_counts import slices

    bounded_batches(docs.sparkSession)
    keep = [id_col, *passing]
    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_text"),
                         F.coalesce(F.col(text_col).rlike(LETTER), F.lit(False)).alias("_letter"))
    fields = [narrow.schema[c] for c in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["lang_pred string", "score double"])

    def run(batches):
        for batch in batches:
            texts = [t if ok else "" for t, ok in zip(batch.column("_text").to_pylist(),
                                                      batch.column("_letter").to_pylist(), strict=True)]
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for i, j in slices(texts, buffer_chars) if net else ():
                p = text_scores(net, texts[i:j])
                best = p.argmax(axis=1)
                for k, b in enumerate(best.tolist()):
                    if texts[i + k]:
                        names[i + k], scores[i + k] = net.langs[b], min(1.0, float(p[k, b]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(names), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"])

    return narrow.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
