"""SQL surface (Q1-Q4, A5, F5, S9): views plus Spark SQL; Catalyst plans it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str) -> DataFrame:
    """Q2: register a temp view; returns the frame for chaining."""
    df.createOrReplaceTempView(name)
    return df


def competition_search(spark: SparkSession, view: str, words: list[str], gender: str = "male",
                       match_type: str = "ODI") -> DataFrame:
    """Q3/A5: distinct (match_type, event) for a gender and type whose event name
    contains every word, case-insensitively."""
    conds = " ".join(f"AND contains(lower(event), lower(:w{i}))" for i in range(len(words)))
    args = {f"w{i}": w for i, w in enumerate(words)} | {"gender": gender, "mt": match_type}
    return spark.sql(f"SELECT DISTINCT match_type, event FROM {view} "
                     f"WHERE gender = :gender {conds} AND match_type = :mt", args=args)


def event_rows(spark: SparkSession, view: str, like: str) -> DataFrame:
    """Rows whose event matches a LIKE pattern and that have no wicket.
    Blanks are nulls in the dataset, so the test is IS NULL."""
    return spark.sql(f"SELECT * FROM {view} WHERE event LIKE :p AND wicket_type IS NULL", args={"p": like})
