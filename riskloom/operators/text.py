"""Row-as-text encoders: TF-IDF, latent semantic components and averaged word vectors.

Rows with the same categories have the same text, so everything is computed once per
distinct text and looked up by the rows.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom import limits
from riskloom.functions.columns import as_category
from riskloom.functions.hashing import normal, order_hash
from riskloom.functions.lookup import fits_broadcast, lookup
from riskloom.session import keep_small, settle, ship

log = logging.getLogger(__name__)

#: Terms that are decomposed as one block; a wider vocabulary is iterated on a block of components + SPARE vectors.
WIDE = 96
SPARE = 24
MOST_STEPS = 60
STILL = 1e-12
#: Shares of the largest value below which a direction counts as absent.
FLAT = 1e-13
#: Partitions on which word vectors are trained and averaged, whatever the cluster.
W2V_PARTS = 8


def rows_to_text(cols: Sequence[str]) -> Column:
    """column_value tokens joined by spaces."""
    return F.concat_ws(" ", *[F.concat(F.lit(f"{c}_"), as_category(c)) for c in cols])


def terms(text: Column, ngram_max: int = 1) -> Column:
    """Lower-case word tokens of two or more characters, with n-grams up to ngram_max."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    if ngram_max <= 1:
        return words

    def grams(n: int) -> Column:
        last = F.size(words) - n
        return F.when(
            last >= 0,
            F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(words, i + 1, n), " ")),
        ).otherwise(F.array().cast("array<string>"))

    return F.concat(words, *[grams(n) for n in range(2, ngram_max + 1)])


def distinct_texts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(rows_to_text(cols).alias("text")).groupBy("text").agg(F.count("*").alias("n"))


def term_rows(texts: DataFrame, ngram_max: int = 1, carry: Sequence[str] = ("text", "n")) -> DataFrame:
    """(..., term, tf) per distinct text."""
    exploded = texts.select(*carry, F.explode(terms(F.col("text"), ngram_max)).alias("term"))
    return exploded.groupBy(*carry, "term").agg(F.count("*").alias("tf"))


def term_weights(texts: DataFrame, ngram_max: int = 1, min_df: int = 5, max_df: float = 0.5) -> DataFrame:
    """(term, df, idf) of the terms kept: df >= min_df and df <= max_df * rows.

    idf = ln((1 + rows) / (1 + df)) + 1.
    """
    rows = texts.agg(F.sum("n").alias("r")).first()["r"] or 0
    freq = term_rows(texts, ngram_max).groupBy("term").agg(F.sum("n").alias("df"))
    return freq.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * rows)).withColumn(
        "idf", F.log((1.0 + rows) / (1.0 + F.col("df"))) + 1.0
    )


def tfidf_rows(
    texts: DataFrame, weights: DataFrame, ngram_max: int = 1, carry: Sequence[str] = ("text", "n"), payload: Sequence[str] = ()
) -> DataFrame:
    """(..., term, tfidf, payload) with unit length per text; a text has as many rows as it has terms.

    Terms that many texts share are looked up without meeting in one task.
    """
    found = lookup(term_rows(texts, ngram_max, carry), weights, "term", ["idf", *payload], "df").filter("idf IS NOT NULL")
    own = Window.partitionBy("text")
    value = F.col("tf") * F.col("idf")
    return found.withColumn("w", value).withColumn("tfidf", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(own))).drop("w", "idf", "tf")


def _sums(values: Column, factor: Column, width: int) -> Column:
    """Sum of ``factor * values`` over a group, place by place."""
    return F.array(*[F.sum(factor * values[i]) for i in range(width)])


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _gram(rows: DataFrame, name: str, width: int) -> np.ndarray:
    """Sum over all rows of the outer product of a vector column with itself.

    A partition sends one row per place of the vector; only width x width numbers reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch, name, width)
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()), "g": pa.array(list(total), pa.list_(pa.float64()))})

    ship(rows.sparkSession)
    parts = rows.select(name).mapInArrow(run, "i int, g array<double>")
    out = np.zeros((width, width))
    for r in parts.groupBy("i").agg(_sums(F.col("g"), F.lit(1.0), width).alias("g")).collect():
        out[r["i"]] = r["g"]
    return (out + out.T) / 2


def _turned(rows: DataFrame, name: str, turn: np.ndarray) -> DataFrame:
    """``rows`` with every vector of a column multiplied by a small matrix."""
    width = turn.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, name, width) @ turn
            ends = np.arange(len(x) + 1, dtype=np.int32) * turn.shape[1]
            vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))
            yield batch.set_column(batch.schema.get_field_index(name), name, vectors)

    ship(rows.sparkSession)
    return rows.mapInArrow(run, rows.schema)


def _ritz(product: np.ndarray, overlap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, largest first, and vectors of the matrix inside a block of vectors with the given overlaps."""
    size = np.sqrt(np.diag(overlap))
    unit = np.divide(1.0, size, out=np.zeros_like(size), where=size > 0)
    share, axes = np.linalg.eigh(overlap * np.outer(unit, unit))
    sound = share > FLAT * share[-1]
    base = unit[:, None] * (axes[:, sound] / np.sqrt(share[sound]))
    value, turn = np.linalg.eigh(base.T @ product @ base)
    value, turn = value[::-1], (base @ turn)[:, ::-1]
    kept = value > FLAT * value[0]
    return value[kept], turn[:, kept]


def leading_terms(cells: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """(term, v array<double>): the k leading right singular vectors of the matrix of ``cells`` (text, term, df, x).

    Block subspace iteration. A step multiplies the block of term vectors by the matrix (a sum per text) and by its
    transpose (a sum per term); inside the block the problem is solved by its width x width products, the only
    numbers that reach the driver. ``WIDE`` terms or fewer are one block, which is exact after the first sum.
    Otherwise steps end when none of the k values moves by more than ``STILL`` of the largest (their vectors then
    hold to about the square root of that), at the latest after ``MOST_STEPS``, which is logged. Vectors of
    vanishing value are left out; the largest entry of each vector is positive. ``index`` is (term, df).
    """
    d = index.count()
    whole = d <= WIDE
    width = d if whole else min(d, max(k + SPARE, WIDE // 2))
    small = 8 * d * width <= limits.BROADCAST_BYTES and fits_broadcast(index)
    if whole:
        names = [r["term"] for r in index.select("term").collect()]
        block = index.sparkSession.createDataFrame([(t, row.tolist()) for t, row in zip(names, np.eye(d), strict=True)], "term string, v array<double>")
        block, overlap = block.join(index, "term"), np.eye(d)
    else:
        block = settle(index.withColumn("v", F.array(*[normal(order_hash(f"lsa:{i}", "term")) for i in range(width)])))
        overlap = _gram(block, "v", width)
    before = np.zeros(0)
    for step in range(MOST_STEPS + 1):
        met = lookup(cells, block, "term", ["v"], "df", small)
        texts = settle(
            met.groupBy("text").agg(F.collect_list(F.struct("term", "df", "x")).alias("cells"), _sums(F.col("v"), F.col("x"), width).alias("y"))
        )
        value, turn = _ritz(_gram(texts, "y", width), overlap)
        lead = value[:k]
        if whole or (len(before) == len(lead) and np.all(np.abs(lead - before) <= STILL * lead[0])):
            break
        if step == MOST_STEPS:
            log.warning("singular values still move by %.1e of the largest after %d steps", np.abs(lead - before).max() / lead[0], step)
            break
        before, width = lead, len(value)
        back = _turned(texts, "y", turn / value).select(F.explode("cells").alias("cell"), "y").select("cell.*", "y")
        block = settle(back.groupBy("term", "df").agg(_sums(F.col("y"), F.col("x"), width).alias("v")))
        overlap = _gram(block, "v", width)
    vectors = settle(_turned(block.select("term", "v"), "v", turn[:, :k]))
    places = [F.col("v")[i] for i in range(len(lead))]
    largest = vectors.agg(*[F.max_by(x, F.struct(F.abs(x), F.col("term"))).alias(f"c{i}") for i, x in enumerate(places)]).first()
    return vectors.select("term", F.array(*[x * float(np.sign(c)) for x, c in zip(places, largest, strict=True)]).alias("v"))


def fit_lsa(df: DataFrame, cols: Sequence[str], k: int, ngram_max: int) -> tuple[DataFrame, list[str]]:
    """Table (term, idf, df, v array<double>) of right singular vectors, and output names.

    Each distinct text enters the matrix once, scaled by the square root of its
    count, which leaves the Gram matrix unchanged. If there are fewer terms than
    components the missing components are zero.
    """
    names = [f"LSA_{i + 1}" for i in range(k)]
    texts = keep_small(distinct_texts(df, cols))
    weights = keep_small(term_weights(texts, ngram_max))
    if weights.isEmpty():
        return weights.select("term", "idf", "df", F.array().cast("array<double>").alias("v")), names
    cells = settle(
        tfidf_rows(texts, weights, ngram_max, payload=["df"]).select("text", "term", "df", (F.col("tfidf") * F.sqrt("n")).alias("x"))
    )
    vectors = leading_terms(cells, weights.select("term", "df"), k)
    return keep_small(weights.join(vectors, "term").select("term", "idf", "df", "v")), names


def apply_lsa(df: DataFrame, cols: Sequence[str], table: DataFrame, names: Sequence[str], ngram_max: int) -> DataFrame:
    """Replace the categorical columns by the components, one projection per distinct text."""
    keyed = df.withColumn("text", rows_to_text(cols))
    texts = distinct_texts(df, cols)
    cells = tfidf_rows(texts, table, ngram_max, payload=["v"])
    parts = cells.groupBy("text", "n").agg(
        *[F.sum(F.col("tfidf") * F.coalesce(F.get(F.col("v"), F.lit(i)), F.lit(0.0))).alias(n) for i, n in enumerate(names)]
    )
    joined = lookup(keyed, keep_small(parts), "text", list(names), "n")
    return joined.select(
        *[c for c in df.columns if c not in cols], *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names]
    )


def word_vectors(model) -> DataFrame:
    return model.getVectors().select(F.col("word").alias("value"), vector_to_array("vector").alias("vector"))


def row_tokens(text: Column, kind: str) -> Column:
    """Whitespace tokens; for fasttext each token also as its 3..6-letter pieces."""
    words = F.split(text, r"\s+")
    if kind == "word2vec":
        return words
    return F.flatten(F.transform(words, _with_pieces))


def _with_pieces(word: Column) -> Column:
    marked = F.concat(F.lit("<"), word, F.lit(">"))
    pieces = [
        F.when(
            F.length(marked) >= n,
            F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))), lambda i: F.substr(marked, i, F.lit(n))),
        ).otherwise(F.array().cast("array<string>"))
        for n in range(3, 7)
    ]
    return F.concat(F.array(marked), *pieces)


def fit_row_embedding(df: DataFrame, cols: Sequence[str], kind: str, dim: int) -> tuple[DataFrame, list[str]]:
    """Word vectors trained on all row texts, window 5, every word kept.

    For fasttext the table holds a vector per letter piece, the mean over the words
    that contain it, so a word not seen in training still gets a vector.
    """
    if kind not in ("word2vec", "fasttext"):
        raise ValueError(f"unknown embedding method: {kind}")
    sentences = df.select(row_tokens(rows_to_text(cols), "word2vec").alias("words"))
    model = Word2Vec(
        vectorSize=dim, windowSize=5, minCount=1, maxIter=5, seed=42, inputCol="words", outputCol="v",
        numPartitions=W2V_PARTS,
    ).fit(sentences)
    vectors = word_vectors(model)
    if kind == "fasttext":
        pieces = vectors.select(F.explode(F.array_distinct(_with_pieces(F.col("value")))).alias("value"), "vector")
        vectors = pieces.groupBy("value").agg(F.array(*[F.avg(F.col("vector")[i]) for i in range(dim)]).alias("vector"))
    return keep_small(vectors), [f"{kind}_{i + 1}" for i in range(dim)]


def apply_row_embedding(df: DataFrame, cols: Sequence[str], kind: str, table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean vector of the known tokens of each distinct text; zeros if none is known."""
    keyed = df.withColumn("text", rows_to_text(cols))
    texts = distinct_texts(df, cols)
    tokens = texts.select("text", "n", F.explode(row_tokens(F.col("text"), kind)).alias("value"))
    means = tokens.join(table, "value").groupBy("text", "n").agg(
        *[F.avg(F.col("vector")[i]).alias(n) for i, n in enumerate(names)]
    )
    joined = lookup(keyed, keep_small(means), "text", list(names), "n")
    return joined.select(
        *[c for c in df.columns if c not in cols], *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names]
    )
