"""trafficlens: web access-log analytics as Spark DataFrame jobs.

Raw combined-format log lines are parsed into a typed table, enriched with
per-client traffic statistics, user-agent and threat-pattern flags and IP/ASN
reputation (two enrichment profiles, ``train`` and ``serve``), labelled,
classified with Spark ML and rolled up into hourly summaries and reports.
Every public function is ``DataFrame -> DataFrame`` and lazy.
"""

__version__ = "0.1.0"
