"""File validation job: profile a JSON-lines export and write the summary as JSON."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playpulse.config import DEFAULT_MINIMUM_PRIVACY_GROUP, argument, build_session, scratch
from playpulse.operators.profile import hash_players, parse_lines, validation_summary
from playpulse.sources.jsonlines import read_json_lines


def profile_files(
    spark: SparkSession,
    input_path: str | list[str],
    salt: str,
    minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP,
    summary_path: str | None = None,
) -> DataFrame:
    """Parse the lines once into Parquet in the shared folder, then compute every metric
    from that copy. JSON parsing (the costly part) runs once; each metric reads only its
    columns, and the parsed copy cuts the lineage back to the text files. The copy holds
    hashed player ids only and is deleted once the summary, one row, is there.

    When ``summary_path`` is given the summary is written there as JSON.
    """
    with scratch(spark) as s:
        parsed_path = s.path("parsed-lines")
        parsed = hash_players(parse_lines(read_json_lines(spark, input_path)), salt)
        parsed.write.mode("overwrite").parquet(parsed_path)
        lazy = validation_summary(spark.read.schema(parsed.schema).parquet(parsed_path), salt=None, minimum_group_size=minimum_group_size)
        summary = kept_row(lazy)
    if summary_path:
        summary.coalesce(1).write.mode("overwrite").json(summary_path)
    return summary


def kept_row(row: DataFrame) -> DataFrame:
    """A one-row result as a DataFrame that reads nothing.

    Maps travel as arrays of entries: a Python dict would lose their order on its way back.
    """
    maps = [f.name for f in row.schema.fields if isinstance(f.dataType, T.MapType)]
    flat = row.withColumns({c: F.map_entries(c) for c in maps})
    kept = row.sparkSession.createDataFrame(flat.collect(), flat.schema)
    return kept.withColumns({c: F.map_from_entries(c) for c in maps})


def main(argv: list[str] | None = None) -> int:
    """``--input=<files> --json=<out dir> [--minimum-group-size=20]``; the salt comes
    from ``--salt=`` or ``PLAYER_HASH_SALT``."""
    argv = sys.argv[1:] if argv is None else argv
    spark = build_session("playpulse-validate")
    salt = argument(argv, "salt", os.environ.get("PLAYER_HASH_SALT", ""))
    summary = profile_files(
        spark,
        argument(argv, "input", ""),
        salt,
        int(argument(argv, "minimum-group-size", str(DEFAULT_MINIMUM_PRIVACY_GROUP))),
        argument(argv, "json", "") or None,
    )
    print(summary.toJSON().first())  # one row
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
