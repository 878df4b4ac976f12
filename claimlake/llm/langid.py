"""Language identification by inference of a document's language mixture.

Training counts hashed character trigrams (a letter with both its neighbours) of every labelled document, per language.
Inference runs expectation-maximisation over each document's trigrams: the expected share of each language explains them
as a mixture. From the shares, nested language sets of every size are fitted again, and the set with the highest
likelihood less a penalty for each language more is selected; the prediction is its largest language, the score its share.

A text that is null or has no letter is `und` with score 0. Rows whose language label is null take no part in training.
Equal shares go to the language that sorts first. Repeated rows are predicted alike; extra columns are ignored. Without
any training row everything is `und`. An empty table gives an empty table. Texts of any length are inferred whole; memory follows the
bytes of a slice of texts, or of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import parts

#: Trigrams are hashed to so many buckets; a model has at most BUCKETS rows for each language.
BITS = 16
BUCKETS = 1 << BITS
STEPS, REFIT_STEPS = 12, 8
#: Bytes and number of texts that are inferred together; a longer text is inferred alone.
TEXT_BYTES, TEXTS = 1 << 20, 250
#: Log-likelihood that each language more has to gain, as a multiple of log(letters), and as a share of the letters.
PENALTY, PENALTY_SHARE = 6.0, 0.02
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point of the basic plane is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each letter of the texts, with its neighbours; other characters count as one and the same."""
    texts = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    table = _letters()
    letter = table[np.minimum(codes, 0xFFFF)]
    if (codes > 0xFFFF).any():
        far = np.flatnonzero(codes > 0xFFFF)
        letter = letter.copy()
        letter[far] = [chr(c).isalpha() for c in codes[far]]
    codes = np.where(letter, codes, 0)
    at = np.flatnonzero(letter)  # never the first or last, which are spaces
    hashed = codes[at - 1] * np.uint32(0x9E3779B1) + codes[at] * np.uint32(0x85EBCA77) + codes[at + 1] * np.uint32(0xC2B2AE3D)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x27D4EB2F)
    return row[at - 1], (hashed >> np.uint32(32 - BITS)).astype(np.int64)


def _counts_of_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table of counts for each language that a partition holds."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in parts(batch):
            names, code = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            row, bucket = trigrams(part.column("text").to_pylist())
            counts = np.bincount(code[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            for name, own in zip(names.tolist(), counts, strict=True):
                totals[name] = totals[name] + own if name in totals else own
    for name, own in totals.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(own[at].astype(np.int64))], ["lang", "bucket", "n"])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, bucket, n): trigram counts over all rows that have a text and a label."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    return rows.mapInArrow(_counts_of_part, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _model(counts: pa.Table) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the probability of each bucket (rows) in each language (columns), by interpolated counts."""
    names = counts.column("lang").to_pylist()
    languages = sorted(set(names))
    n = np.zeros((BUCKETS, len(languages)))
    column = {name: i for i, name in enumerate(languages)}
    n[counts.column("bucket").to_numpy(), [column[x] for x in names]] = counts.column("n").to_numpy()
    if not languages:
        return [], n.astype(np.float32)
    shared = n.sum(axis=1, keepdims=True) + 1.0
    smooth = 2_000.0 * shared / shared.sum()
    return languages, ((n + smooth) / (n.sum(axis=0) + 2_000.0)).astype(np.float32)


def _fit(p: np.ndarray, count: np.ndarray, of: np.ndarray, starts: np.ndarray, total: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares (rows: documents) after some steps, and the log-likelihood under them. Zero shares stay zero."""
    for _ in range(steps):
        joint = p * share[of]
        joint *= (count / joint.sum(axis=1))[:, None]
        share = np.add.reduceat(joint, starts, axis=0) / total[:, None]
    return share, np.add.reduceat(np.log((p * share[of]).sum(axis=1)) * count, starts)


def infer(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Language shares of each text (rows) under the selected set; a row of zeros has no letter."""
    out = np.zeros((len(texts), table.shape[1]), np.float32)
    row, bucket = trigrams(texts)
    if not len(row) or not table.shape[1]:
        return out
    key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, bucket, count = key >> BITS, key & (BUCKETS - 1), count.astype(np.float32)
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    present, of = row[starts], np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(row)]))
    total, p = np.add.reduceat(count, starts), table[bucket]
    share, _ = _fit(p, count, of, starts, total, np.full((len(starts), p.shape[1]), 1 / p.shape[1], np.float32), STEPS)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
    best = best_value = None
    penalty = PENALTY * np.log(total + 1) + PENALTY_SHARE * total
    for size in range(1, p.shape[1] + 1):
        start = np.where(rank < size, np.maximum(share, 1e-3), 0).astype(np.float32)
        start /= start.sum(axis=1, keepdims=True)
        fitted, value = _fit(p, count, of, starts, total, start, REFIT_STEPS if size > 1 else 0)
        value = value - (size - 1) * penalty
        if best is None:
            best, best_value = fitted, value
        else:
            better = value > best_value
            best, best_value = np.where(better[:, None], fitted, best), np.where(better, value, best_value)
    out[present] = best
    return out


PREDICTED = "lang_pred string, score double, mixture map<string,double>"


def _predicted(sent, key: str):
    """The key column, and the prediction of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, table = sent.value
        for batch in batches:
            for part in parts(batch, most_bytes=TEXT_BYTES, most_rows=TEXTS):
                shares = infer(part.column("text").to_pylist(), table)
                known = shares.sum(axis=1) > 0 if len(languages) else np.zeros(len(shares), bool)
                top = shares.argmax(axis=1) if len(languages) else np.zeros(len(shares), int)
                name = [languages[i] if ok else UNDETERMINED for i, ok in zip(top, known, strict=True)]
                score = [min(1.0, float(s[i])) if ok else 0.0 for s, i, ok in zip(shares, top, known, strict=True)]
                mixture = [[(languages[i], round(float(s[i]), 4)) for i in np.flatnonzero(s > 0.005)] for s in shares]
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(mixture, pa.map_(pa.string(), pa.float64()))], [key, "lang_pred", "score", "mixture"])

    return run


def predict(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, mixture): mixture maps each language of the selected set to its share.

    The model has at most BUCKETS rows for each language, whatever the size of the corpus; it comes to the driver in columns and is sent to all
    workers as one number for each bucket and language.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_model(model.toArrow()))
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(_predicted(sent, "key"), f"key {kind}, {PREDICTED}").withColumnRenamed("key", id_col)


def labelled(docs: DataFrame, model: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score, mixture): every row of docs, as a struct, with its prediction; no join, so ids may repeat or be null."""
    sent = docs.sparkSession.sparkContext.broadcast(_model(model.toArrow()))
    texts = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(_predicted(sent, "row"), f"row {texts.schema['row'].dataType.simpleString()}, {PREDICTED}")


def in_fold(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """Whether a row belongs to the held-out fold."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold
