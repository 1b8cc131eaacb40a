"""creditspark: credit-risk scoring operators expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers/writers and the applicant-table builders
functions  column expressions (caps, cuts, recodes, log-odds, points)
operators  DataFrame-level operators: quality, prep, profile, woe, sampling,
           models, evaluate, scorecard
plans      end-to-end flows (IV ranking, model evaluation, reject inference)
streaming  scoring of a streaming DataFrame with fitted, stateless models
"""

from creditspark.session import get_spark, scratch_path, checkpoint_dir

__all__ = ["get_spark", "scratch_path", "checkpoint_dir"]
