"""Taste factors (M4-M8): implicit ALS, factor vectors, standardisation."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: (user, song) rows of an ALS block, on average, at most.
ROWS_PER_BLOCK = 4_000_000


def als_blocks(rows: int, least: int = 10, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    """Blocks of users and of songs for so many (user, song) rows: ``least``, and more where a block
    would hold more than ``rows_per_block`` rows.

    spark.ml builds a block in one task, on the heap and outside Spark's memory management: 12 bytes a row in
    the shuffled pieces, the growing arrays, their copy and the sort buffer, about 50 bytes a row together."""
    return max(least, -(-rows // rows_per_block))


def fit_taste_factors(activity: DataFrame, rank: int = 4, max_iter: int = 8, reg: float = 0.01,
                      alpha: float = 1.0, seed: int = 1, blocks: int = 10,
                      user_col: str = "UserIndex", item_col: str = "SongIndex",
                      rating_col: str = "hits", checkpoint_interval: int = 4,
                      rows_per_block: int = ROWS_PER_BLOCK) -> ALSModel:
    """M4: implicit-feedback ALS on (user, song, hits).

    Always pass a seed: PySpark's default seed is a hash of the class name,
    which changes between Python processes.  ALS blocks its input by id and
    draws each block's first factors by block number, so the factors depend on
    the number of blocks.  It comes from the activity's rows alone (``als_blocks``: ``blocks``,
    10 as in spark.ml, up to 40 million rows), which gives the same factors on any
    cluster.  A block is one task per half-iteration.

    The factor RDDs are checkpointed to the shared checkpoint folder every
    ``checkpoint_interval`` iterations (spark.ml's default of 10 never fires
    within 8), so an executor lost late in the fit does not send Spark back
    through every earlier iteration.  Checkpointing does not change the
    factors."""
    checkpoint_root(activity.sparkSession)  # ALS skips checkpoints without a dir
    blocks = als_blocks(activity.count(), blocks, rows_per_block)  # a written table is counted from its footers
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed,
              userCol=user_col, itemCol=item_col, ratingCol=rating_col,
              numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=checkpoint_interval)
    return als.fit(activity.select(user_col, item_col, rating_col))


def user_factors(model: ALSModel) -> DataFrame:
    """M5: (id int, features array<float>)."""
    return model.userFactors


def factor_vectors(factors: DataFrame, include_id: bool = True,
                   id_col: str = "id", array_col: str = "features") -> DataFrame:
    """M6/M7 + P7: (id, features vector) from the whole array.

    The reference assembles every column left after splitting the factor
    array - the id first, then the factors - so the id is a clustering
    feature; ``include_id=False`` clusters on the factors alone."""
    values = F.col(array_col).cast("array<double>")
    if include_id:
        values = F.concat(F.array(F.col(id_col).cast("double")), values)
    return factors.select(id_col, array_to_vector(values).alias("features"))


def vectorize_columns(df: DataFrame, exclude: tuple[str, ...] = (), out_col: str = "features") -> DataFrame:
    """M7: every column (but ``exclude``) assembled into one vector column,
    in column order - the reference's general helper."""
    cols = [c for c in df.columns if c not in exclude and c != out_col]
    return VectorAssembler(inputCols=cols, outputCol=out_col).transform(df)


def standardise(vectors: DataFrame, id_col: str = "id", features_col: str = "features") -> DataFrame:
    """M8: subtract the mean and divide by the sample standard deviation,
    per dimension; (id, features).  One aggregation job for the moments."""
    scaler = StandardScaler(inputCol=features_col, outputCol="_scaled", withMean=True, withStd=True)
    scaled = scaler.fit(vectors).transform(vectors)
    return scaled.select(id_col, F.col("_scaled").alias(features_col))
