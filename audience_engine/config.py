"""Run configuration for the listener-clustering and notification-CTR job.

The defaults give the reference job's figures; the switches give the
defaults differ from the reference in the rows they keep, not in any count:
``distinct_audience`` (a set, not a bag) and ``dedupe_clicks``.
"""

from __future__ import annotations

from dataclasses import dataclass

# The reference job's settings, which the defaults below keep.
#   ALS: rank 4, 8 iterations, regularisation 0.01, alpha 1.0, implicit feedback
#   K-means: k 275, 20 iterations, tolerance 0.0001
#   top notifications: 5
#   k search: 250 to 280 in steps of 4
REFERENCE_K_SWEEP = range(250, 281, 4)


@dataclass(frozen=True)
class PipelineConfig:
    # implicit ALS (M4): the reference's settings
    rank: int = 4
    max_iter: int = 8
    reg: float = 0.01
    alpha: float = 1.0
    als_seed: int = 1
    # blocks of users and of songs (spark.ml's default), and more where a block would
    # hold more than so many (user, song) rows: a block must fit the heap of one task.
    # spark.ml draws the first factors per block, so the factors depend on the
    # number: it comes from these settings and the rows, never from the cores
    als_blocks: int = 10
    als_rows_per_block: int = 4_000_000

    # K-means (M9): k 275 and spark.ml defaults otherwise
    k: int = 275
    kmeans_max_iter: int = 20
    kmeans_tol: float = 1e-4
    kmeans_seed: int = 1
    # partitions of the points in the fit; k-means|| samples per partition, so the
    # centres depend on this number (fixed for the same reason as als_blocks)
    kmeans_partitions: int = 8
    # search k over k_from, k_from + k_step, ... k_to instead of taking ``k``
    search_k: bool = False
    k_from: int = REFERENCE_K_SWEEP.start
    k_to: int = REFERENCE_K_SWEEP[-1]
    k_step: int = REFERENCE_K_SWEEP.step

    # the user index is a clustering feature in the reference [fact 1]
    include_id: bool = True

    # artist popularity counts (user, song) pairs [fact 2]; "plays" sums hits
    weight: str = "pairs"
    # the reference's audience is a bag; a set leaves every CTR unchanged [fact 7]
    distinct_audience: bool = True
    # repeated clicks of one user on one notification collapse before the
    # join; False keeps them, and with distinct_audience=False the clicked
    # rows are then exactly the reference's notified-clicks output (K2)
    dedupe_clicks: bool = True
    # CTR join on NotificationId alone ("reference") or per-notification sums
    # before the join ("exact") [fact 5]
    fanout: str = "reference"
    # notifications without a click vanish in the reference [fact 6]
    keep_zero_click: bool = False
    # top notifications by clicks (reference) or by CTR [fact 4]
    rank_by: str = "clicks"
    top_n: int = 5

    # rows of one key (a song, an artist, a notification) that one task may hold: a hotter key is
    # salted by its exact count, one salt for so many rows
    rows_per_task: int = 1_000_000
    # rows of one notification in a file of the partitioned sink (K2)
    rows_per_file: int = 1_000_000
    # buckets of the activity by song: one task each in the popularity count, so about
    # (user, song) rows / rows_per_task
    song_buckets: int = 8
    # silhouette and WSSSE after the fit, as the reference prints every time
    evaluate: bool = True
    # write the audience too (K1), in files of at most this many rows
    write_audience: bool = False
    audience_rows_per_file: int = 1_000_000
