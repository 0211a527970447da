"""Language identification with error-correcting output codes.

Every language has a codeword; one linear classifier over hashed byte n-grams predicts each bit.
Decoding sums the logistic loss of the bits against each codeword, weighted by how reliable the
bit was in training, and takes the nearest codeword. A small gap to the second one is flagged.

The classifiers are fitted on a bounded sample (``rows_per_lang`` rows a language and ``max_rows``
in all, those with the smallest text hash); prediction reads every whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is every text
when nothing was learned; repeated rows and texts get equal results; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name

UND = "und"
DIM = 4096
ROWS_PER_LANG = 500
MAX_ROWS = 4000
AMBIGUOUS_MARGIN = 0.05
# ASCII letters in lower case, other ASCII as blanks, bytes of longer characters as they are
_FOLD = bytes((b | 0x20) if 65 <= b <= 90 else (b if 97 <= b <= 122 or b >= 128 else 32) for b in range(256))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte bigrams and trigrams (unit length)."""
    b = np.frombuffer((" " + text + " ").encode("utf-8", "replace").translate(_FOLD), dtype=np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(263) + b[2:] + np.uint32(1 << 25)
    grams = np.concatenate([two[(b[:-1] != 32) | (b[1:] != 32)], three[(two[:-1] != 32 * 257 + 32)]])
    idx = (grams * np.uint32(2654435761)) >> np.uint32(20)  # 12 bits: DIM buckets
    c = np.bincount(idx, minlength=DIM).astype(np.float32)
    return np.sqrt(c / max(c.sum(), 1.0))


def has_letter(text: str | None) -> bool:
    return text is not None and any(ch.isalpha() for ch in text)


def codebook(n: int, seed: int = 7) -> np.ndarray:
    """Codewords (n x bits) of +-1: all splits of the languages up to 5, else random ones far apart."""
    if n <= 1:
        return np.ones((n, 0))
    if n <= 5:
        bits = np.arange(1, 2 ** (n - 1))
        return np.array([[1 if i == 0 or not (int(b) >> (i - 1)) & 1 else -1 for b in bits] for i in range(n)])
    rng, width, best, best_d = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        c = rng.choice([-1, 1], size=(n, width))
        d = ((c @ c.T) - width * np.eye(n) * 2).max()
        if (best is None or -d > best_d) and (abs(c.sum(0)) < n).all():
            best, best_d = c, -d
    return best


@dataclass
class Model:
    langs: list
    code: np.ndarray  # langs x bits
    weights: np.ndarray  # DIM x bits
    bias: np.ndarray
    reliability: np.ndarray  # langs x bits, rows sum to 1
    margin: float = AMBIGUOUS_MARGIN

    def decode(self, x: np.ndarray):
        """(language index, score, ambiguous) of each feature row."""
        if len(self.langs) == 1:
            n = len(x)
            return np.zeros(n, int), np.ones(n), np.zeros(n, bool)
        f = x @ self.weights + self.bias
        loss = np.log1p(np.exp(-np.clip(self.code[None] * f[:, None, :], -30, 30)))
        total = (loss * self.reliability[None]).sum(2)
        p = np.exp(-(total - total.min(1, keepdims=True)) * self.code.shape[1])
        p /= p.sum(1, keepdims=True)
        top = np.sort(p, 1)
        return p.argmax(1), top[:, -1], (top[:, -1] - top[:, -2]) < self.margin


def fit(x: np.ndarray, y: list, steps: int = 300, rate: float = 40.0, decay: float = 1e-6) -> Model:
    """Logistic regressions, one per bit, by gradient descent with momentum on the bounded sample."""
    langs = sorted(set(y))
    code = codebook(len(langs))
    row = np.array([langs.index(v) for v in y], int)
    bits = code.shape[1]
    w, b = np.zeros((x.shape[1] if len(x) else DIM, bits), np.float32), np.zeros(bits, np.float32)
    if bits:
        t = code[row].astype(np.float32)
        share = 1.0 / np.bincount(row, minlength=len(langs))[row]
        share = (share / share.sum()).astype(np.float32)[:, None]
        vw, vb = np.zeros_like(w), np.zeros_like(b)
        for _ in range(steps):
            g = -t / (1 + np.exp(np.clip(t * (x @ w + b), -30, 30))) * share
            vw = 0.9 * vw - rate * 0.1 * (x.T @ g + decay * w)
            vb = 0.9 * vb - 0.1 * g.sum(0)
            w, b = w + vw, b + vb
        right = ((x @ w + b) * t > 0)
        rel = np.array([right[row == i].mean(0) if (row == i).any() else np.ones(bits) for i in range(len(langs))])
        rel = np.maximum(rel, 1e-3)
        rel = rel / rel.sum(1, keepdims=True)
    else:
        rel = np.ones((len(langs), 0))
    return Model(langs, code, w, b, rel)


def train(df: DataFrame, text: str = "text", lang: str = "lang", rows_per_lang: int = ROWS_PER_LANG,
          max_rows: int = MAX_ROWS) -> Model | None:
    """Fit on the rows of ``df`` with a text and a language; None if there are none."""
    rows = df.select(df[text].alias("text"), df[lang].alias("lang")).where("text is not null and lang is not null")
    keyed = rows.select("lang", F.xxhash64("text").alias("h"))
    # hashes below a threshold that a few times the sample falls under, whatever the table's size
    about = keyed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    limit = F.lit(float(-1 << 63)) + F.lit(float(1 << 64)) * F.least(F.lit(1.0), F.lit(4.0 * rows_per_lang + 100) / F.col("n"))
    seen = (keyed.join(F.broadcast(about.select(F.col("lang").alias("l"), limit.alias("limit"))), F.col("lang") == F.col("l"))
            .where(F.col("h") <= F.col("limit")).select("lang", "h").distinct())
    per_lang = Window.partitionBy("lang").orderBy("h")
    picked = seen.withColumn("r", F.row_number().over(per_lang)).where(F.col("r") <= rows_per_lang).collect()
    langs = sorted({r["lang"] for r in picked})
    if not langs:
        return None
    each = max(1, min(rows_per_lang, max_rows // len(langs)))
    wanted = {(r["lang"], r["h"]) for r in picked if r["r"] <= each}
    keys = df.sparkSession.createDataFrame(sorted(wanted), "klang string, kh long")
    hit = (rows.withColumn("h", F.xxhash64("text"))
           .join(F.broadcast(keys), (F.col("lang") == F.col("klang")) & (F.col("h") == F.col("kh")), "left_semi")
           .select("lang", "h", "text"))

    def vectors(batches):
        for b in batches:
            for l, h, t in zip(b[0].to_pylist(), b[1].to_pylist(), b[2].to_pylist()):
                yield pa.RecordBatch.from_pydict({"lang": [l], "h": pa.array([h], pa.int64()),
                                                  "v": [features(t).tobytes()]})

    once = hit.mapInArrow(vectors, "lang string, h long, v binary").groupBy("lang", "h").agg(F.min("v").alias("v"))
    got = sorted(once.collect(), key=lambda r: (r["lang"], r["h"]))
    x = np.stack([np.frombuffer(r["v"], np.float32) for r in got])
    return fit(x, [r["lang"] for r in got])


def predict(df: DataFrame, model: Model | None, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out``: ``lang_pred``, ``score``, ``ambiguous``."""
    field = T.StructField(out, T.StructType([T.StructField("lang_pred", T.StringType()),
                                             T.StructField("score", T.DoubleType()),
                                             T.StructField("ambiguous", T.BooleanType())]))
    at = df.columns.index(text)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            lang, score, flag = [UND] * n, [0.0] * n, [False] * n
            texts = batch.column(at)
            for lo in range(0, n, 256):  # features of a few texts at a time
                rows, xs = [], []
                for i in range(lo, min(lo + 256, n)):
                    t = texts[i].as_py()
                    if model is not None and has_letter(t):
                        rows.append(i)
                        xs.append(features(t))
                if rows:
                    k, s, a = model.decode(np.stack(xs))
                    for i, ki, si, ai in zip(rows, k, s, a):
                        lang[i], score[i], flag[i] = model.langs[ki], float(si), bool(ai)
            res = pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(flag, pa.bool_())],
                names=["lang_pred", "score", "ambiguous"])
            yield pa.RecordBatch.from_arrays([*batch.columns, res], names=[*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, field]))


def held_out(id_col):
    """True for documents whose crc32(id as text) mod 3 is 1 (they are never learned from)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, then label every row: a struct column ``language``."""
    model = train(df.where(~held_out(df[id_col])), text, lang)
    return predict(df, model, text, free_name(df, "language"))
