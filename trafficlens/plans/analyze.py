"""End-to-end analysis (M10): filter -> enrich -> classify -> hourly table + report.

One lazy chain; the classified frame is materialised once (it feeds the
hourly table, the report and the caller) into the shared checkpoint folder.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.dims import materialize, scope
from ..operators.parse import filter_status
from ..operators.reports import summary_report
from ..operators.summary import hourly_summary
from . import enrich as EN
from . import model as MD


def analyze(parsed: DataFrame, model: PipelineModel, blocklist: DataFrame,
            malicious_user_agents: list[str] | None = None, whitelist: str | None = None,
            blacklist: str | None = None, tiebreak: list[str] | None = None,
            materialize_result: bool = True, **enrich_options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (classified rows, hourly summary, summary report).

    ``enrich_options`` go to :func:`enrich.enrich_serve` (``scope``,
    ``old_browser``, ``lag_bucket``, ``max_broadcast_rows``).
    """
    rows = filter_status(parsed, whitelist, blacklist)
    # The written result no longer reads the per-key tables cached on the way.
    with scope() if materialize_result else nullcontext():
        enriched = EN.enrich_serve(rows, blocklist, malicious_user_agents, tiebreak=tiebreak, **enrich_options)
        classified = MD.classify(model, enriched)
        if materialize_result:
            classified = materialize(classified)
    return classified, hourly_summary(classified), summary_report(classified)


PACKAGE_OPTIONS = {"whitelist", "blacklist", "scope", "old_browser", "lag_bucket", "max_broadcast_rows", "malicious_user_agents"}


def analyze_packaged(spark: SparkSession, path: str, parsed: DataFrame, blocklist: DataFrame,
                     **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """IO12: :func:`analyze` with a saved package's model and its own filter and profile options.

    ``options`` override the package's.  A package of another profile than
    ``serve``, or with an unknown option, raises.
    """
    model, config = MD.load(spark, path)
    profile = config.pop("profile", "serve")
    unknown = set(config) - PACKAGE_OPTIONS
    if profile != "serve" or unknown:
        raise ValueError(f"package of profile {profile!r} with unknown options {sorted(unknown)}")
    return analyze(parsed, model, blocklist, **(config | options))
