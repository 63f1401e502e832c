"""reelframe — catalog analytics (titles, people, credits, genres, ratings) on Spark.

Every public function takes DataFrames plus plain parameters and returns a lazy
DataFrame; nothing is collected to the driver inside the library.

Sub-packages:

- ``sources``    catalog views, CSV ingest, sinks, storage statistics, layout writer
- ``functions``  column-expression helpers (name matching, decades, histograms)
- ``operators``  cleaning/quarantine, profiling, distributions, integrity audit,
                 nested-document build, copy + verify
- ``plans``      the nine catalog questions in three formulations, full-film lookup,
                 flat-vs-nested comparison
- ``streaming``  the row-level cleaning rules on a streaming source
"""

from reelframe.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
