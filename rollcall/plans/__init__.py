from rollcall.plans.suite import JOB_NAMES, Settings, run_jobs

__all__ = ["JOB_NAMES", "Settings", "run_jobs"]
