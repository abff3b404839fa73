"""Scoring new documents, in batch or as a stream.

The same narrow select serves both: fit the row to the plan, set aside what cannot be
scored, encode, predict, decode.  There is no state and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwright.functions.paths import col
from tabwright.operators.clean import REASON, UNREADABLE, accepted, clean_columns, quarantined, target_attribute
from tabwright.operators.encode import DEFAULT, decode, encode_rows
from tabwright.operators.features import ROW, feature_row
from tabwright.operators.search import Ensemble


def checked_rows(df: DataFrame, ensemble: Ensemble, pos: str | None = "pos") -> DataFrame:
    """Rows fitted to the plan without its target, with the reason where that failed.

    A NULL ``doc`` (text that was not JSON) is unreadable, whatever defaults would say.
    """
    keep = ("doc",) if "doc" in df.columns else ()
    rows = clean_columns(df, ensemble.attributes, pos, target_needed=False, keep=keep)
    if keep:
        rows = rows.withColumn(
            REASON, F.when(F.col("doc").isNull(), F.lit(UNREADABLE)).otherwise(F.col(REASON))
        ).drop("doc")
    return rows


def score_checked(checked: DataFrame, ensemble: Ensemble, unseen: str = DEFAULT) -> DataFrame:
    """Attributes as fitted to the plan plus the predicted target."""
    target = target_attribute(ensemble.attributes)
    features = [a for a in ensemble.attributes if not a.is_target]
    good = accepted(checked)
    kept = [c for c in good.columns if c not in {a.path for a in features}]
    # Codes feed the model, the texts stay in the result.
    texts = F.struct(*[col(a.path) for a in features]).alias("_row")
    coded = encode_rows(good.select("*", texts), features, unseen).select(
        *kept, "_row", feature_row(features).alias(ROW)
    )
    predicted = ensemble.predict(coded)
    value = decode(F.col("yhat"), target) if ensemble.problem.n_labels else F.col("yhat")
    return predicted.select(*kept, "_row.*", value.alias(target.path), "proba")


def score(df: DataFrame, ensemble: Ensemble, pos: str | None = "pos", unseen: str = DEFAULT) -> DataFrame:
    """C1 for a batch or a streaming DataFrame; rejected rows are not in the result."""
    return score_checked(checked_rows(df, ensemble, pos), ensemble, unseen)


def score_rejects(df: DataFrame, ensemble: Ensemble, pos: str | None = "pos") -> DataFrame:
    return quarantined(checked_rows(df, ensemble, pos))


def score_stream(
    source: DataFrame,
    ensemble: Ensemble,
    out_path: str,
    quarantine_path: str,
    checkpoint: str,
    pos: str | None = "pos",
    unseen: str = DEFAULT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Scored rows and set-aside rows go to two folders, once per micro-batch.

    Folders are written per batch id, so a batch replayed after a failure replaces its
    own files instead of adding to them.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        checked = checked_rows(batch, ensemble, pos).persist()
        score_checked(checked, ensemble, unseen).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        quarantined(checked).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        checked.unpersist()

    return (
        source.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
