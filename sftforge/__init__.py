"""Spark-native preparation and evaluation of instruction-tuning data.

Sub-packages:

* ``functions`` -- column expressions (normalize, pick, fold, filter, prompt, score).
* ``operators`` -- DataFrame-to-DataFrame steps (dedup, sample, fold, generate, compare).
* ``sources``   -- readers, writers and the dataset registry.
* ``plans``     -- the three end-to-end jobs: prepare, distill, evaluate.
* ``streaming`` -- the stateless part of prepare applied to a streaming source.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
