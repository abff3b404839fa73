"""Profile and plan of one table in one call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.config import EstimatorSpec
from tabwright.operators.clean import Attribute, selected_attributes
from tabwright.operators.discovery import discover
from tabwright.operators.observe import Layout, observations, with_target
from tabwright.operators.profile import long_texts, medians, profile, value_freq, with_texts
from tabwright.operators.rules import attribute_plan, label_encoders, label_order
from tabwright.sources.scratch import written


@dataclass(frozen=True)
class Planned:
    n_docs: int
    profile: DataFrame
    plan: DataFrame
    encoders: DataFrame

    def attributes(self) -> list[Attribute]:
        return selected_attributes(self.plan, self.encoders)


def plan_table(kept: DataFrame, spec: EstimatorSpec) -> Planned:
    """Plan rows that already have a target; frequencies and plan are written once for all readers."""
    layout = Layout(kept.schema, (spec.pos,) if spec.pos else ())
    # The pass that looks for the documents' paths counts them, too.
    found = discover(kept, layout.variants) if layout.variants else None
    n_docs = found.n_rows if found else kept.count()
    obs = observations(kept, spec.pos, found=found)
    freq = written(value_freq(obs, layout.fixed_types()), "value_freq")
    profiled = written(profile(freq), "profile")
    plan = written(attribute_plan(profiled, medians(freq), n_docs, spec), "plan")
    encoders = label_encoders(freq, plan)
    keys = profiled.select("path", F.explode(F.array("mode", "min_label")).alias("text")).unionByName(
        encoders.select("path", F.col("label").alias("text"))
    )
    texts = long_texts(obs, keys)
    return Planned(
        n_docs, with_texts(profiled, texts, ["mode", "min_label"]), with_texts(plan, texts, ["default_text"]),
        label_order(with_texts(encoders, texts, ["label"])),
    )


def planned(df: DataFrame, spec: EstimatorSpec) -> Planned:
    """Filter on the target, profile, decide."""
    return plan_table(with_target(df, spec.target, (spec.pos,) if spec.pos else ()), spec)
