"""audience_engine - find each artist's audience from a play log and measure
notification click-through, as Spark DataFrame / spark.ml jobs."""

from .config import PipelineConfig
from .plans.pipeline import ClusteredListeners, JobResult, cluster_listeners, popular_artists, run
from .session import checkpoint_root, cut_lineage, local_session, scratch_path
from .sources.tables import Inputs, inputs_from_tables

__all__ = [
    "PipelineConfig", "ClusteredListeners", "JobResult", "cluster_listeners", "popular_artists", "run",
    "checkpoint_root", "cut_lineage", "local_session", "scratch_path", "Inputs", "inputs_from_tables",
]
