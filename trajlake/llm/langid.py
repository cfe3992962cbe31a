"""Language ID with string kernels: presence kernels on blended n-gram spectra, Nyström landmarks, and kernel ridge regression.

A text's spectrum is the set of its character n-grams (2 to 4 letters, word edges included), hashed to ``BITS`` places. The
kernel of two texts is the size of the common set over the geometric mean of the two sizes. With the landmarks' presence
matrix L (rows of unit length) and a batch's presence matrix P, the batch's kernel columns are P L'. The Nyström feature map
is (P L') K^(-1/2), and one-versus-rest ridge regression on it gives weights B; so scores are P (L' K^(-1/2) B), and the
bracket is one matrix that every worker multiplies its batches with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from trajlake.llm.common import lean, rows_of

#: Places of the hashed spectrum.
BITS = 1 << 15
GRAMS = (2, 3, 4)
#: Letters worked on at once; longer texts come in pieces that overlap by the longest n-gram.
PIECE = 1 << 18
#: Texts of a batch that are scored by one matrix product.
ROWS = 128


@dataclass
class Model:
    """labels in order of code point; weights[place, label]; floor: half of the least best output on the texts learnt from."""

    labels: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BITS, 0), np.float32))
    floor: float = 0.0


_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def spectrum(text: str | None, row: np.ndarray) -> bool:
    """Sets the places of a text's n-grams in a row of bytes; False if it has no letter."""
    if not text:
        return False
    found, overlap = False, np.array([32], np.uint32)
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        found |= bool(letter.any())
        codes = np.where(letter, codes, 32)
        space = codes == 32
        keep = ~(space & np.concatenate(([overlap[-1] == 32], space[:-1])))
        codes = np.concatenate((overlap, codes[keep]))
        last = at + PIECE >= len(text)
        if last and codes[-1] != 32:
            codes = np.append(codes, np.uint32(32))
        h = np.zeros(len(codes), np.uint32)
        with np.errstate(over="ignore"):
            for n in range(1, max(GRAMS) + 1):
                size = len(codes) - n + 1
                if size <= 0:
                    break
                h = (h[:size] * np.uint32(0x01000193)) ^ (codes[n - 1 :] * np.uint32(0x9E3779B1))
                if n in GRAMS:
                    row[(h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 15)] = 1
        overlap = codes[-(max(GRAMS) - 1) :]
    return found


def _sample(docs: DataFrame, text: str, label: str, per_label: int, seed: int) -> list[tuple[str, bytes]]:
    """Packed spectra of at most ``per_label`` different texts of each label, those with the smallest seeded hash of the text alone."""
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t"), F.col(label).cast("string").alias("l"), F.xxhash64(F.col(text), F.lit(seed)).alias("h"))
    sizes = {r["l"]: r["n"] for r in known.groupBy("l").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    if not sizes:
        return []
    # Hashes below a bound keep about 1.5 times the sample; the exact cut follows on that bounded rest.
    share = F.lit(1.0)
    for k, n in sizes.items():
        share = F.when(F.col("l") == k, F.lit(min(1.0, (1.5 * per_label + 50) / max(n, 1)))).otherwise(share)
    some = known.where((F.col("h").cast("double") + 2.0**63) / 2.0**64 < share)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for t, k, x in rows_of(batch, ["t", "l", "h"]):
                row = np.zeros(BITS, np.uint8)
                if (k, x) not in seen and spectrum(t, row):  # a text that a third of all rows have is one row
                    seen.add((k, x))
                    yield pa.RecordBatch.from_pydict({"l": [k], "h": [x], "bits": [np.packbits(row).tobytes()]})

    packed = some.mapInArrow(lean(pack), "l string, h long, bits binary").groupBy("l", "h").agg(F.first("bits").alias("bits"))
    ranked = packed.groupBy("l").agg(F.expr(f"slice(array_sort(collect_list(struct(h, bits))), 1, {per_label})").alias("x"))
    return sorted((r["l"], bytes(x["bits"])) for r in ranked.collect() for x in r["x"])


def fit(docs: DataFrame, text: str = "text", label: str = "lang", per_label: int = 300, landmarks_per_label: int = 64, ridge: float = 1e-3, seed: int = 11) -> Model:
    """Learns from at most ``per_label`` texts of each label (the documented bound of the sample: 4 KB of bits each go to the driver).

    Rows with a null text, a null label or no letter teach nothing; equal texts of a label count as one. Without any row to learn from, the model has no labels.
    """
    rows = _sample(docs, text, label, per_label, seed)
    if not rows:
        return Model()
    labels = sorted({k for k, _ in rows})
    x = np.unpackbits(np.frombuffer(b"".join(b for _, b in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
    x /= np.sqrt(x.sum(1, keepdims=True))
    y = np.array([[k == c for c in labels] for k, _ in rows], np.float64)
    seen: dict[str, int] = {}
    chosen = []
    for i, (k, _) in enumerate(rows):
        seen[k] = seen.get(k, 0) + 1
        if seen[k] <= landmarks_per_label:
            chosen.append(i)
    marks = x[chosen]
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = value > 1e-8 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    z = (x @ marks.T).astype(np.float64) @ root
    b = np.linalg.solve(z.T @ z + ridge * len(rows) * np.eye(z.shape[1]), z.T @ y)
    return Model(labels, (marks.T.astype(np.float64) @ (root @ b)).astype(np.float32), float((z @ b).max(1).min()) / 2)


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "lang_score"), reject: bool = False) -> DataFrame:
    """The input with the language and its score appended under the two names, in place of columns of those names.

    The score is the best class's share of the positive parts of all scores, from 0 to 1. Null texts and texts without a
    letter are ``und`` with score 0; so are all texts under a model without labels. Ties go to the first label. Whole texts
    are read, in pieces of bounded size. With ``reject``, a text whose best output is below the model's floor is ``und`` with
    score 0 too: it is like none of the texts learnt from, in whatever share. The model (at most 32,768 numbers per label) goes to the workers with the function.
    """
    labels, weights, floor = model.labels, model.weights, model.floor
    kept = [c for c in docs.columns if c not in names]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                p = np.zeros((batch.num_rows, BITS), np.uint8)
                texts = batch.column(text).to_pylist()
                found = np.array([spectrum(t, row) for t, row in zip(texts, p, strict=True)], bool)
                found_names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
                if labels and found.any():
                    p = p[found].astype(np.float32)
                    f = np.maximum((p @ weights) / np.sqrt(p.sum(1, keepdims=True)), 0).astype(np.float64)
                    total = f.sum(1)
                    best = f.argmax(1)
                    found_names[found] = np.array(labels, object)[best]
                    top = f[np.arange(len(f)), best]
                    scores[found] = np.where(total > 0, top / np.where(total > 0, total, 1), 0)
                    if reject:
                        none = np.flatnonzero(found)[top < floor]
                        found_names[none], scores[none] = "und", 0
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found_names, pa.string()), pa.array(scores)], names=[*kept, *names])

    given = docs.select(*kept)
    schema = StructType([*given.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    return given.mapInArrow(lean(score), schema)
