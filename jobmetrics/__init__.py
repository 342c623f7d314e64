"""Job telemetry analytics on Spark: one wide row per job, plus overview reports."""

from jobmetrics.plans.runs import RunConfig, run, run_plan
from jobmetrics.session import build_session, configure

__all__ = ["RunConfig", "build_session", "configure", "run", "run_plan"]
