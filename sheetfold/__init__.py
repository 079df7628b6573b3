"""sheetfold — turn folders of hand-kept workbook grids into clean fact tables on Spark.

Sub-packages:

* ``functions`` — Column expressions: Unicode strip, locale numbers, multi-format dates,
  project ids, month labels.
* ``sources``   — grid readers, workbook listings, test fixtures, sinks.
* ``operators`` — sheet layout (header discovery, carve, widths), header naming, joins with
  a size-checked broadcast, dense row ids, alert flags, audit counts.
* ``plans``     — the three end-to-end jobs: finance, budget, timesheets.
"""

from sheetfold.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
