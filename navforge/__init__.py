"""navforge: a layered fund-administration data pipeline on Spark DataFrames.

Layers: raw all-text ``bronze`` -> validated ``silver`` + quarantine -> ``gold``
reporting tables -> ``ops`` quality monitoring.  Entry points:

- :func:`navforge.plans.pipeline.run` — the whole batch run, every layer written;
- :func:`navforge.operators.quality.validate` and the operators in
  :mod:`navforge.operators.gold`, :mod:`navforge.operators.ops`,
  :mod:`navforge.operators.reports` — the individual DataFrame steps;
- :mod:`navforge.specs` — the datasets and their data-quality rules.
"""

__version__ = "0.1.0"
