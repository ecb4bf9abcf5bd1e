"""Free-text product descriptions -> product categories.

Two faces of the same work:

* term tables (``token_rows``, ``term_frequency``, ``tfidf_terms``) -- exact,
  per-term, written as explode + groupBy + equi-joins, so they run at any scale
  with codegen and are checkable against SQL;
* the ML pipeline (``fit_categories``): Tokenizer-equivalent split, stop-word
  removal, HashingTF and IDF as a ``pyspark.ml.Pipeline``, principal components
  by distributed products (``lowrank``), KMeans; fitted on distinct
  descriptions and saved/loaded as a ``CategoryModel``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import IDF, ElementwiseProduct, HashingTF, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import LINE_SALT, left_lookup, split_join
from ..functions.text import WHITESPACE, stop_words
from ..session import materialize
from .lowrank import principal_components, project


def distinct_descriptions(bronze: DataFrame, col: str = "Description") -> DataFrame:
    """Distinct non-null descriptions (the tokenizer rejects null input)."""
    return bronze.select(col).where(F.col(col).isNotNull()).distinct()


def token_array(text_col: str, keep_empty: bool = False):
    """lower + split on single whitespace characters, as a Column of tokens.
    ``keep_empty=True`` keeps the empty strings a run of blanks produces."""
    toks = F.split(F.lower(F.col(text_col)), WHITESPACE)
    return toks if keep_empty else F.filter(toks, lambda t: t != F.lit(""))


def token_rows(df: DataFrame, id_col: str, text_col: str, remove_stop: bool = True,
               language: str = "english") -> DataFrame:
    """(id, pos, token): one row per kept token; ``pos`` is the 0-based index
    in the whitespace split. Stop words go through a broadcast anti-join with
    the fixed stop-word list (a hash probe per token, no per-row list scan)."""
    t = df.select(id_col, F.posexplode(F.split(F.lower(F.col(text_col)), WHITESPACE)).alias("pos", "token"))
    t = t.where(F.col("token") != "")
    if remove_stop:
        spark = df.sparkSession
        sw = spark.createDataFrame([(w,) for w in stop_words(language)], "token string")
        t = t.join(F.broadcast(sw), "token", "left_anti")
    return t.select(id_col, "pos", "token")


def tokens(df: DataFrame, id_col: str, text_col: str, keep_empty: bool = False,
           remove_stop: bool = True, language: str = "english") -> DataFrame:
    """Token arrays per row (order and repeats kept), as the ML Tokenizer +
    StopWordsRemover produce them (empty tokens dropped unless asked)."""
    out = df.select(id_col, token_array(text_col, keep_empty).alias("words"))
    if remove_stop:
        remover = StopWordsRemover(inputCol="words", outputCol="_kept", stopWords=list(stop_words(language)))
        out = remover.transform(out).select(id_col, F.col("_kept").alias("words"))
    return out


def term_frequency(tok: DataFrame, id_col: str) -> DataFrame:
    """(id, token, tf): exact term counts per document (the un-hashed twin of
    HashingTF)."""
    return tok.groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("tf"))


def dealt_by_id(docs: DataFrame, id_col: str, most: int = 1_000) -> DataFrame:
    """``docs`` dealt by id, so that the terms of a document are counted where
    it lies and no (id, token) row is shuffled. Where an id (null, say) has more
    than ``most`` rows they stay spread, and its counts are shuffled by token."""
    rows = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if rows > most:
        return docs
    # A number that AQE keeps: texts grow when they are split into terms.
    return docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), id_col)


def hashed_tf(docs: DataFrame, id_col: str, text_col: str, num_features: int = 4096) -> DataFrame:
    """(id, bucket, tf): hashed term counts as the ML pipeline makes them
    (MurmurHash3 of the UTF-8 bytes, seed 42, modulo ``num_features``; tokens
    without empty ones and stop words). Null texts have no rows."""
    words = tokens(docs.where(F.col(text_col).isNotNull()), id_col, text_col)
    vectors = HashingTF(inputCol="words", outputCol="tf_features", numFeatures=num_features).transform(words)
    entries = vectors.select(id_col, F.unwrap_udt("tf_features").alias("v")).select(
        id_col, F.explode(F.arrays_zip("v.indices", "v.values")).alias("x"))
    return entries.select(id_col, F.col("x.indices").alias("bucket"), F.col("x.values").cast("long").alias("tf"))


def nearest_centre(vector, centres: list[list[float]]):
    """Number of the nearest of the stored ``centres`` to an array column (ties:
    the lowest number): the assignment step as plain column expressions."""
    def squared(centre: list[float]):
        gaps = F.zip_with(vector, F.array(*map(F.lit, map(float, centre))), lambda x, c: (x - c) * (x - c))
        return F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g)

    far = F.array(*[squared(c) for c in centres])
    return F.array_position(far, F.array_min(far)).cast("int") - 1


def assign_stored(docs: DataFrame, text_col: str, centres: list[list[float]]) -> DataFrame:
    """(text, category): each text's hashed counts, one bucket a dimension of
    the stored centres, assigned to the nearest."""
    words = docs.select(text_col, F.col(text_col).alias("_text"))
    words = words.withColumn("words_raw", token_array("_text")).drop("_text")
    kept = StopWordsRemover(inputCol="words_raw", outputCol="words", stopWords=list(stop_words("english"))).transform(words)
    v = HashingTF(inputCol="words", outputCol="tf_features", numFeatures=len(centres[0])).transform(kept)
    return v.select(text_col, nearest_centre(vector_to_array("tf_features"), centres).alias("ProductCategoryID"))


def tfidf_terms(docs: DataFrame, tok: DataFrame, id_col: str, min_doc_freq: int = 2,
                digits: int = 9) -> DataFrame:
    """(id, token, tf, df, idf, tfidf) with idf = ln((N+1)/(df+1)), 0 when the
    term is in fewer than ``min_doc_freq`` documents. N counts every input
    document, including those left with no token. Values rounded to
    ``digits`` decimals."""
    n_docs = docs.select(id_col).count()
    # tokenizing whole texts is the expensive part: the tf table is written
    # once (shared checkpoint folder) and both branches below read it.
    tf = materialize(term_frequency(tok, id_col), "term_frequency")
    # one row per (doc, term) already: df is a count over tf (partial
    # aggregation absorbs a hot term); the join back hashes a part of the
    # vocabulary, so the tf table is not sorted, and AQE can split a hot term.
    dfreq = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = F.when(F.col("df") >= min_doc_freq,
                 F.log(F.lit(float(n_docs + 1)) / (F.col("df") + F.lit(1.0)))).otherwise(F.lit(0.0))
    dfreq = dfreq.withColumnRenamed("token", "_term")
    return (split_join(tf, dfreq.hint("shuffle_hash"), F.col("token"), F.col("_term"), "inner")
            .withColumn("idf_raw", idf)
            .select(id_col, "token", "tf", "df",
                    F.round(F.col("idf_raw"), digits).alias("idf"),
                    F.round(F.col("tf") * F.col("idf_raw"), digits).alias("tfidf")))


# ----------------------------------------------------------------------------
# ML pipeline
# ----------------------------------------------------------------------------
MIN_DOC_FREQ = 2
#: Rows of a partition of the fit: the layout depends on the data alone.
FIT_ROWS = 20_000


def feature_pipeline(num_features: int = 4096, text_col: str = "Description", keep_empty: bool = False) -> Pipeline:
    """Description -> tf-idf vector: split, stop words, hashed counts, IDF."""
    from pyspark.ml.feature import SQLTransformer, Tokenizer
    if keep_empty:
        tok = Tokenizer(inputCol=text_col, outputCol="words_raw")
    else:
        tok = SQLTransformer(statement=(
            f"SELECT *, filter(split(lower(`{text_col}`), '{WHITESPACE}'), t -> t != '') AS words_raw "
            "FROM __THIS__"))
    return Pipeline(stages=[
        tok, StopWordsRemover(inputCol="words_raw", outputCol="words"),
        HashingTF(inputCol="words", outputCol="tf_features", numFeatures=num_features),
        IDF(inputCol="tf_features", outputCol="tfidf_features", minDocFreq=MIN_DOC_FREQ)])


def fit_features(src: DataFrame, num_features: int, text_col: str, keep_empty: bool, weight: str | None = None) -> PipelineModel:
    """The feature pipeline, fitted. With ``weight`` a row counts as that many
    equal rows: the document frequencies of the buckets are weighted sums, and
    the IDF stage is their fixed product."""
    pipeline = feature_pipeline(num_features, text_col, keep_empty)
    if weight is None:
        return pipeline.fit(src)
    *stages, idf = pipeline.getStages()
    counted = PipelineModel(stages=stages).transform(src).select(weight, F.unwrap_udt("tf_features").alias("v"))
    total = counted.agg(F.sum(weight)).first()[0] or 0
    freq = counted.select(weight, F.explode("v.indices").alias("b")).groupBy("b").agg(F.sum(weight).alias("df")).collect()
    scale = np.zeros(num_features)  # num_features rows at most
    for r in freq:
        if r["df"] >= MIN_DOC_FREQ:
            scale[r["b"]] = np.log((total + 1.0) / (r["df"] + 1.0))
    product = ElementwiseProduct(inputCol=idf.getInputCol(), outputCol=idf.getOutputCol(), scalingVec=Vectors.dense(scale))
    return PipelineModel(stages=[*stages, product])


@dataclass
class CategoryModel:
    """Fitted features, principal components (num_features x k, or None) and
    clusters."""
    features: PipelineModel
    components: np.ndarray | None
    clusters: KMeansModel
    order: list[int] | None = None  # category id of each of the fit's clusters

    def reduced(self, df: DataFrame) -> DataFrame:
        out = self.features.transform(df)
        if self.components is None:
            return out
        return out.withColumn("pca_features", array_to_vector(project(F.col("tfidf_features"), self.components)))

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.clusters.transform(self.reduced(df))
        if self.order is None:
            return out
        ids = F.array(*map(F.lit, self.order))
        return out.withColumn("ProductCategoryID", F.get(ids, F.col("ProductCategoryID")))

    def save(self, path: str) -> None:
        self.features.write().overwrite().save(f"{path}/features")
        self.clusters.write().overwrite().save(f"{path}/clusters")
        spark = SparkSession.getActiveSession()
        rows = [] if self.components is None else [(i, r.tolist()) for i, r in enumerate(self.components)]
        spark.createDataFrame(rows, "i int, row array<double>").write.mode("overwrite").parquet(f"{path}/components")
        spark.createDataFrame([(self.order,)], "ids array<int>").write.mode("overwrite").parquet(f"{path}/order")

    @staticmethod
    def load(path: str) -> "CategoryModel":
        spark = SparkSession.getActiveSession()
        rows = sorted(spark.read.parquet(f"{path}/components").collect(), key=lambda r: r["i"])  # num_features rows
        return CategoryModel(PipelineModel.load(f"{path}/features"),
                             np.array([r["row"] for r in rows]) if rows else None, KMeansModel.load(f"{path}/clusters"),
                             spark.read.parquet(f"{path}/order").first()["ids"])


def description_table(bronze: DataFrame, text_col: str = "Description") -> DataFrame:
    """Distinct descriptions written once to the shared checkpoint folder.

    Every estimator in the pipeline makes its own pass over its input (IDF,
    PCA's mean and Gramian, k-means init) and transform makes another; with the
    product catalogue written once, those passes scan a small table instead of
    re-running the order-line joins."""
    return materialize(distinct_descriptions(bronze, text_col), "descriptions")


def fit_categories(bronze: DataFrame, num_features: int = 4096, pca_k: int | None = 50, k: int = 10,
                   seed: int = 42, dedupe: bool = True, text_col: str = "Description",
                   descriptions: DataFrame | None = None, keep_empty: bool = False) -> CategoryModel:
    """Fit the description model on distinct descriptions (``dedupe``), or on
    every line: then each distinct description counts as many times as it has
    lines, in the document frequencies, the components and the clusters, and no
    line gets a vector of its own. Components come from distributed products
    with a thin matrix (``lowrank``), so the width of the features costs the
    driver no dense covariance. A ``pca_k`` beyond ``num_features`` raises.

    The result does not depend on how the input is partitioned: the fit's rows
    are dealt by a hash of the description into a number of partitions that
    follows from their count, in order, and categories are numbered by falling
    size, then by their first description."""
    if pca_k and pca_k > num_features:
        raise ValueError(f"pca_k={pca_k} exceeds num_features={num_features}")
    weight = None if dedupe else "_lines"
    if dedupe:
        src = descriptions if descriptions is not None else description_table(bronze, text_col)
    else:
        lines = bronze.where(F.col(text_col).isNotNull()).groupBy(text_col).agg(F.count(F.lit(1)).alias(weight))
        src = materialize(lines, "description-lines")
    features = fit_features(src, num_features, text_col, keep_empty, weight)
    vectors = features.transform(src).select(text_col, "tfidf_features", *([weight] if weight else []))
    parts = max(1, -(-src.count() // FIT_ROWS))
    vectors = materialize(vectors.repartition(parts, text_col).sortWithinPartitions(text_col), "category-vectors")
    # Files may be split or joined when they are read: deal again.
    vectors = vectors.coalesce(1) if parts == 1 else vectors.repartition(parts, text_col).sortWithinPartitions(text_col)
    comp = principal_components(vectors, "tfidf_features", num_features, pca_k, seed, weight, parts) if pca_k else None
    col = "tfidf_features"
    if comp is not None:
        vectors, col = vectors.withColumn("pca_features", array_to_vector(project(F.col(col), comp))), "pca_features"
    means = KMeans(k=k, seed=seed, featuresCol=col, predictionCol="ProductCategoryID")
    clusters = (means.setWeightCol(weight) if weight else means).fit(vectors)
    sizes = clusters.transform(vectors).groupBy("ProductCategoryID").agg(
        F.sum(weight or F.lit(1)).alias("n"), F.min(text_col).alias("first")).collect()  # k rows
    ranked = [r["ProductCategoryID"] for r in sorted(sizes, key=lambda r: (-r["n"], r["first"]))]
    ranked += [c for c in range(len(clusters.clusterCenters())) if c not in ranked]
    return CategoryModel(features, comp, clusters, [ranked.index(c) for c in range(len(ranked))])


def categorize(model: CategoryModel, bronze: DataFrame, text_col: str = "Description",
               descriptions: DataFrame | None = None) -> DataFrame:
    """(Description, ProductCategoryID) for every distinct description."""
    src = descriptions if descriptions is not None else distinct_descriptions(bronze, text_col)
    return (model.transform(src)
            .select(text_col, F.col("ProductCategoryID").cast("int").alias("ProductCategoryID")))


def attach_category(bronze: DataFrame, categorized: DataFrame, labels: DataFrame) -> DataFrame:
    """Silver: order lines + ProductCategoryID (left join on Description; the
    right side is one row per description, so no fan-out; a null description
    keeps a null category) + ProductCategoryName (left join on the label table,
    reduced to one row per category id; its size is left to the planner)."""
    with_id = left_lookup(bronze, categorized.select("Description", "ProductCategoryID"), "Description",
                          salt_cols=[c for c in LINE_SALT if c in bronze.columns] or None)
    return with_id.join(labels.dropDuplicates(["ProductCategoryID"]), "ProductCategoryID", "left")


def default_labels(categorized: DataFrame, tok_tfidf: DataFrame, n_terms: int = 3,
                   text_col: str = "Description") -> DataFrame:
    """(ProductCategoryID, ProductCategoryName): the top ``n_terms`` terms by
    summed tf-idf in each category, joined with spaces (ties: term asc)."""
    t = (tok_tfidf.join(categorized, text_col)
         .groupBy("ProductCategoryID", "token").agg(F.sum("tfidf").alias("weight")))
    w = Window.partitionBy("ProductCategoryID").orderBy(F.col("weight").desc(), F.col("token"))
    top = t.withColumn("term_rank", F.row_number().over(w)).where(F.col("term_rank") <= n_terms)
    return (top.groupBy("ProductCategoryID")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("term_rank", "token"))),
                                          lambda s: s["token"]), " ").alias("ProductCategoryName")))


def category_terms(silver: DataFrame, n_terms: int = 3, id_col: str = "ProductCategoryID",
                   text_col: str = "Description") -> DataFrame:
    """Top terms per category by summed tf-idf over the category's distinct
    descriptions: (category, token, weight, term_rank)."""
    d = silver.where(F.col(text_col).isNotNull()).select(id_col, text_col).distinct()
    docs = d.select(text_col).distinct()
    tok = token_rows(docs, text_col, text_col)
    tf = tfidf_terms(docs, tok, text_col)
    t = tf.join(d, text_col).groupBy(id_col, "token").agg(F.round(F.sum("tfidf"), 6).alias("weight"))
    w = Window.partitionBy(id_col).orderBy(F.col("weight").desc(), F.col("token"))
    return t.withColumn("term_rank", F.row_number().over(w)).where(F.col("term_rank") <= n_terms)

