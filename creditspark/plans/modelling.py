"""Path B: applicant table -> encoded, split, balanced design for the models.

Encoding is fitted on the training side only (the reference scaled the whole
table before splitting, a leak; SURVEY 2.14) and travels with the design:
categorical WOE, ten-bin WOE for the NULL-bearing bureau columns, z-scores
for the remaining numeric columns.  The split is the exact hash split (SA1)
and the balanced training set is the smoothed bootstrap (SA3).
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.operators import prep, sampling, woe
from creditspark.operators.models import assemble, reliable

CATEGORICAL = ["segment", "priority", "nation"]
NULL_BEARING = ["n_trades", "qty", "util", "bal"]
SCALED = ["tenure_days", "income", "price"]
FEATURES = [f"z_{c}" for c in SCALED] + [f"woe_{c}" for c in NULL_BEARING + CATEGORICAL]


@dataclass
class Design:
    train: DataFrame        # encoded training rows (application_id, tag, FEATURES)
    test: DataFrame         # encoded holdout rows
    balanced: DataFrame     # smoothed-bootstrap balanced training rows
    features: list[str]
    encoder: woe.WoeModel
    scaler: prep.StandardizerModel

    def vectors(self, which: str = "balanced") -> DataFrame:
        df = {"train": self.train, "test": self.test, "balanced": self.balanced}[which]
        return assemble(df, self.features, "tag", keep=["application_id"])

    def encode(self, df: DataFrame) -> DataFrame:
        """Apply the fitted encoders to any applicant rows (labelled or not)."""
        enc = self.scaler.transform(self.encoder.transform(df, prefix="woe_"), prefix="z_")
        return enc.select("application_id", "tag", *self.features)


def build_design(mt: DataFrame, seed: int = 100, ratio: float = 0.7, balance: bool = True,
                 min_share: float = 0.03) -> Design:
    split = sampling.stratified_split(mt, "application_id", "tag", ratio, seed)
    split = reliable(split)  # cut lineage once; every model below re-reads this
    train_raw = split.filter("is_train").drop("is_train")
    test_raw = split.filter(~F.col("is_train")).drop("is_train")
    encoder = woe.WoeBinner("tag", categorical=CATEGORICAL, numeric=NULL_BEARING, k=10,
                            min_share=min_share).fit(train_raw)
    scaler = prep.Standardizer(SCALED).fit(train_raw)

    features = [f for f in FEATURES if f not in {f"z_{c}" for c in scaler.constant}]
    if len(features) < len(FEATURES):
        warnings.warn(f"left out of the design, being constant: {scaler.constant}", stacklevel=2)

    def enc(df):
        e = scaler.transform(encoder.transform(df, prefix="woe_"), prefix="z_")
        return e.select("application_id", "tag", *features)

    train, test = enc(train_raw), enc(test_raw)
    if balance:
        bal = sampling.rose_balance(train.dropna(subset=features), "application_id", "tag", features, seed=1)
        bal = reliable(bal.drop("copy"))
    else:
        bal = train
    return Design(train, test, bal, features, encoder, scaler)
