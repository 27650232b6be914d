"""pipewright — a PySpark-native revenue-funnel analytics engine.

Layers (all lazy DataFrames until a table is materialized):
sources -> raw (dedupe) -> staging (clean) -> entity (derive) ->
operational tables -> reports, plus data-quality checks on every layer.

    from pipewright import Pipeline
    pl = Pipeline.from_driver(spark, "/root/testdata/sf0.1")
    pl.rpt_funnel_summary.show()
"""

from .params import DEFAULT, Params
from .plans import Pipeline
from .sources import Sources

__all__ = ["DEFAULT", "Params", "Pipeline", "Sources"]
