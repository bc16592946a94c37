"""Model-backed columns: embeddings, themes, summaries, semantic search.

Hosted models are injected as plain functions; the defaults run offline.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..functions.text import PROMPT_SYSTEM, proposition_text, render_prompt

# Vector size, request batch size, score threshold, summary lines.
DIMENSIONS = 1536
EMBED_BATCH = 50
THRESHOLD = 0.30
SUMMARY_LINES = 3

# Request batches whose rows are handed back to Spark together.
FRAME_BATCHES = 20

# Everything but letters, marks, digits and '_' separates tokens.
_NOT_WORD = r"[^\p{L}\p{M}\p{Nd}_]+"

# Theme vectors are held by every task as one matrix; more themes than this
# many bytes of float64 are scored in several exact rounds.
MATRIX_BYTES = 64 * 1024 * 1024

Encoder = Callable[[Sequence[str]], tuple[Sequence[Sequence[float]], int]]
Generator = Callable[[str], tuple[str, int, int]]


def pending_embedding(proposicoes: DataFrame, limit: int | None = None) -> DataFrame:
    rows = proposicoes.where(F.col("embedding").isNull() & (F.col("ementa") != ""))
    return rows if limit is None else rows.orderBy("proposicao_id").limit(limit)


def pending_classification(proposicoes: DataFrame, limit: int | None = None) -> DataFrame:
    rows = proposicoes.where(F.col("embedding").isNotNull() & F.col("tema_id").isNull())
    return rows if limit is None else rows.orderBy("proposicao_id").limit(limit)


def pending_summary(proposicoes: DataFrame, limit: int | None = None) -> DataFrame:
    """Most recent first, undated last (the id breaks ties)."""
    rows = proposicoes.where(F.col("resumo_executivo").isNull() & (F.col("ementa") != ""))
    order = (F.col("data_apresentacao").desc_nulls_last(), F.col("proposicao_id"))
    return rows if limit is None else rows.orderBy(*order).limit(limit)


# --- embeddings ---------------------------------------------------------------

def hashed_embedding(df: DataFrame, text: str, output: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """Offline encoder: hashed token counts scaled to length 1, JVM-side. Also
    adds ``tokens``, the number of tokens of the whole text."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _NOT_WORD), lambda w: w != "")
    tokens = df.withColumn("_words", words).withColumn("tokens", F.size("_words").cast("bigint"))
    counted = HashingTF(numFeatures=dimensions, inputCol="_words", outputCol="_tf").transform(tokens)
    scaled = Normalizer(inputCol="_tf", outputCol="_unit").transform(counted)
    return scaled.withColumn(output, vector_to_array("_unit", "float32")).drop("_words", "_tf", "_unit")


def embed(proposicoes: DataFrame, encoder: Encoder, batch_size: int = EMBED_BATCH) -> DataFrame:
    """(proposicao_id, embedding, tokens, erro). Texts go to the encoder in
    batches; a failing batch keeps a NULL vector and its message, so finished
    batches are never lost. Tokens are booked on the first row of a batch."""
    return embed_texts(
        proposicoes.select("proposicao_id", proposition_text(F.col("tipo"), F.col("ementa")).alias("texto")), encoder, batch_size)


def embed_texts(rows: DataFrame, encoder: Encoder, batch_size: int = EMBED_BATCH) -> DataFrame:
    """``embed`` for rows (proposicao_id, texto). Rows leave in frames of ``FRAME_BATCHES`` batches."""
    def asked(texts: list[str]) -> tuple[list, list, list]:
        none = [None] * len(texts)
        try:
            found, used = encoder(texts)
            vectors = [np.asarray(v, dtype=np.float32) for v in found]
            if len(vectors) != len(texts):
                raise ValueError(f"Length of values ({len(vectors)}) does not match length of index ({len(texts)})")
            return vectors, [used] + [0] * (len(texts) - 1), none
        except Exception as exc:  # one bad batch must not end the job
            return none, [0] * len(texts), [str(exc)] * len(texts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = batch_size * FRAME_BATCHES
        for frame in frames:
            for first in range(0, len(frame), size):
                part = frame.iloc[first:first + size]
                texts = part["texto"].tolist()
                done = [asked(texts[at:at + batch_size]) for at in range(0, len(texts), batch_size)]
                vectors, tokens, errors = ([x for batch in column for x in batch] for column in zip(*done))
                out = pd.DataFrame({"proposicao_id": part["proposicao_id"], "tokens": tokens, "erro": pd.Series(errors, part.index, dtype=object)})
                out["embedding"] = pd.Series(vectors, part.index, dtype=object)
                yield out[["proposicao_id", "embedding", "tokens", "erro"]]

    return rows.mapInPandas(run, "proposicao_id INT, embedding ARRAY<FLOAT>, tokens BIGINT, erro STRING")


# --- theme classification -----------------------------------------------------

def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths != 0)


def _scorer(ids: np.ndarray, matrix: np.ndarray):
    """Pandas UDF: best theme and cosine of each vector. Ids are ascending, so
    the first maximum is the lowest id. A null vector, or one of another
    length than the themes', has no theme and the score 0."""
    units = _unit_rows(matrix)

    @F.pandas_udf("tema_id INT, score DOUBLE")
    def best(vectors: pd.Series) -> pd.DataFrame:
        fit = vectors.map(lambda v: v is not None and len(v) == units.shape[1]).to_numpy(dtype=bool)
        out = pd.DataFrame({"tema_id": pd.array([None] * len(vectors), dtype="Int32"), "score": 0.0})
        if fit.any():
            scores = _unit_rows(np.stack(vectors.to_numpy()[fit]).astype(np.float64)) @ units.T
            # equal directions must tie exactly
            scores = np.round(scores, 12)
            winner = scores.argmax(axis=1)
            out.loc[fit, "tema_id"] = ids[winner]
            out.loc[fit, "score"] = scores[np.arange(len(scores)), winner]
        return out

    return best


def best_theme(df: DataFrame, themes: DataFrame, vector: str = "embedding") -> DataFrame:
    """Adds ``melhor_tema`` and ``score``: the theme of highest cosine, lowest
    id on ties, 0.0 for a vector without length. ``themes`` has ``tema_id``
    and ``vetor``; its size decides between one matrix and several rounds."""
    shape = themes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vetor")).alias("d")).first()
    count, width = shape["n"], shape["d"]
    if not count:
        return df.withColumn("melhor_tema", F.lit(None).cast("int")).withColumn("score", F.lit(0.0))
    rounds = -(-count * width * 8 // MATRIX_BYTES)
    part = F.pmod(F.xxhash64("tema_id"), F.lit(rounds))
    best = None
    for number in range(rounds):
        rows = themes.where(part == number).select("tema_id", "vetor").orderBy("tema_id").collect()
        if not rows:
            continue
        ids = np.array([r["tema_id"] for r in rows], dtype=np.int32)
        found = _scorer(ids, np.array([r["vetor"] for r in rows], dtype=np.float64))(F.col(vector))
        df = df.withColumn("_found", found)
        ranked = F.struct(F.col("_found.score").alias("s"), (-F.col("_found.tema_id")).alias("t"))
        df = df.withColumn("_best", ranked if best is None else F.greatest("_best", ranked)).drop("_found")
        best = True
    return df.withColumn("melhor_tema", -F.col("_best.t")).withColumn("score", F.col("_best.s")).drop("_best")


def classify(proposicoes: DataFrame, themes: DataFrame, threshold: float = THRESHOLD, vector: str = "embedding") -> DataFrame:
    """``tema_id`` is assigned when the best score reaches the threshold
    (inclusive) and stays NULL otherwise."""
    scored = best_theme(proposicoes, themes, vector)
    return scored.withColumn("tema_id", F.when(F.col("score") >= threshold, F.col("melhor_tema")))


def classification_counts(classified: DataFrame) -> DataFrame:
    return classified.agg(
        F.count("tema_id").alias("classificadas"),
        F.count_if(F.col("tema_id").isNull()).alias("sem_tema"),
    )


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Component-wise mean vector per key: (key, vetor)."""
    cells = df.select(key, F.posexplode(vector).alias("_i", "_x"))
    means = cells.groupBy(key, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    # one entry per component: bounded by the vector size
    ordered = F.array_sort(F.collect_list(F.struct("_i", "_m")))
    return means.groupBy(key).agg(F.transform(ordered, lambda e: e["_m"]).alias("vetor"))


# --- semantic search ----------------------------------------------------------

def search(df: DataFrame, query: Sequence[float], key: str, vector: str = "embedding", k: int = 10) -> DataFrame:
    """Exact top-k by cosine; each task keeps k candidates (id breaks ties)."""
    target = np.asarray([query], dtype=np.float64)
    found = _scorer(np.zeros(1, dtype=np.int32), target)(F.col(vector))
    scored = df.select(key, found["score"].alias("score"))
    return scored.orderBy(F.desc("score"), F.col(key)).limit(k)


def search_approx(
    df: DataFrame, query: Sequence[float], key: str, vector: str = "embedding", k: int = 10,
    bucket_length: float = 0.5, hash_tables: int = 6, seed: int = 7,
) -> DataFrame:
    """Approximate top-k by random-projection hashing of unit vectors."""
    unit = np.asarray(query, dtype=np.float64)
    unit = unit / (np.linalg.norm(unit) or 1.0)
    rows = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    rows = Normalizer(inputCol="_v", outputCol="_unit").transform(rows)
    lsh = BucketedRandomProjectionLSH(
        inputCol="_unit", outputCol="_hash", bucketLength=bucket_length, numHashTables=hash_tables, seed=seed
    )
    from pyspark.ml.linalg import Vectors

    near = lsh.fit(rows).approxNearestNeighbors(rows, Vectors.dense(unit), k, distCol="_dist")
    score = F.lit(1.0) - F.col("_dist") * F.col("_dist") / 2
    return near.select(key, score.alias("score"))


# --- summaries ----------------------------------------------------------------

_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"\w+")


def summary(text: str, lines: int = SUMMARY_LINES) -> str:
    """Offline generator: the sentences whose words are most typical of the
    whole text, in their original order."""
    sentences = [s.strip() for s in _SENTENCE_END.split(text) if s.strip()]
    weights = Counter(_WORD.findall(text.lower()))

    def typical(sentence: str) -> float:
        words = _WORD.findall(sentence.lower())
        return sum(weights[w] for w in words) / len(words) if words else 0.0

    ranked = sorted(range(len(sentences)), key=lambda i: (-typical(sentences[i]), i))[:lines]
    return "\n".join(sentences[i] for i in sorted(ranked))


def offline_generator(text: str) -> tuple[str, int, int]:
    out = summary(text)
    return out, len(_WORD.findall(text)), len(_WORD.findall(out))


def summarize(
    proposicoes: DataFrame, generator: Generator = offline_generator, *, prompt: bool = False, key: str = "proposicao_id"
) -> DataFrame:
    """(key, resumo_executivo, tokens_in, tokens_out, erro). ``prompt`` sends
    the system text and the rendered prompt to the generator instead of the bare text."""
    asked = F.concat(F.lit(f"{PROMPT_SYSTEM}\n\n"), render_prompt(F.col("tipo"), F.col("ementa")))
    text = asked if prompt else F.col("ementa")
    rows = proposicoes.select(key, text.alias("texto"))
    schema = StructType([rows.schema[key]]).simpleString()[len("struct<"):-1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for ident, body in zip(frame[key], frame["texto"]):
                try:
                    text_out, used_in, used_out = generator(body)
                    out.append((ident, text_out.strip(), used_in, used_out, None))
                except Exception as exc:  # one bad text must not end the job
                    out.append((ident, None, 0, 0, str(exc)))
            yield pd.DataFrame(out, columns=[key, "resumo_executivo", "tokens_in", "tokens_out", "erro"])

    return rows.mapInPandas(run, f"{schema}, resumo_executivo string, tokens_in bigint, tokens_out bigint, erro string")
