"""End-to-end plans (C1, C7) and the query registry."""

from .pipeline import ClusteredListeners, JobResult, analyse, audience_of, cluster_listeners, popular_artists, run

__all__ = ["ClusteredListeners", "JobResult", "analyse", "audience_of", "cluster_listeners", "popular_artists", "run"]
