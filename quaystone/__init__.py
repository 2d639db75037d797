"""quaystone — contract-gated table pipelines as Spark DataFrame jobs.

Stages (all DataFrame in, DataFrame out, executed on the cluster):

* ``operators.profile``  — column profile, top values, duplicates
* ``operators.eda``      — descriptive statistics, correlations, histograms
* ``operators.clean``    — closed-vocabulary cleaning plan executor
* ``operators.measure``  — contract measurement (observed facts)
* ``operators.gate``     — deterministic validation gate → findings table
* ``operators.faults``   — seeded, pure fault injectors
* ``operators.calibrate``— resampling tolerance calibration
* ``operators.features`` / ``train`` / ``evaluate`` / ``claims`` — Spark ML side
* ``operators.runs``     — gated publish, run records, replay
"""

__version__ = "0.1.0"
