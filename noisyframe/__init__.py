"""noisyframe: weak-label analytics (features, label noise, cleaning, ensembles) on Spark.

Layers: ``sources`` (tables, frames, labelled text), ``functions`` (seeded keys,
exact order statistics), ``operators`` (feature, label-quality, sampling and
learning operators), ``plans`` (pipelines and the registered query catalog).
"""

__version__ = "0.1.0"
