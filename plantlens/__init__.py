"""plantlens: plant-quality, equipment-effectiveness and cost analytics on Spark.

Raw tables -> silver (cleaned) -> gold (aggregated) layers, written as lazy
DataFrame plans so Catalyst can prune, push down and fuse across layers.
"""

from plantlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
