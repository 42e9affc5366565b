"""Zachary's karate club (1977): the small graph used for tests and first steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The 78 friendships, as neighbours of larger number per member.
FRIENDS = {
    0: [1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12, 13, 17, 19, 21, 31],
    1: [2, 3, 7, 13, 17, 19, 21, 30],
    2: [3, 7, 8, 9, 13, 27, 28, 32],
    3: [7, 12, 13],
    4: [6, 10],
    5: [6, 10, 16],
    6: [16],
    8: [30, 32, 33],
    9: [33],
    13: [33],
    14: [32, 33],
    15: [32, 33],
    18: [32, 33],
    19: [33],
    20: [32, 33],
    22: [32, 33],
    23: [25, 27, 29, 32, 33],
    24: [25, 27, 31],
    25: [31],
    26: [29, 33],
    27: [33],
    28: [31, 33],
    29: [32, 33],
    30: [32, 33],
    31: [32, 33],
    32: [33],
}

#: Members who stayed with the instructor; the others followed the officer.
INSTRUCTOR, OFFICER = "Mr. Hi", "Officer"
STAYED = [0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12, 13, 16, 17, 19, 21]
MEMBERS = 34


def karate_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """``(id, category)`` and ``(src, dst, w)``."""
    members = [(i, INSTRUCTOR if i in STAYED else OFFICER) for i in range(MEMBERS)]
    friends = [(a, b, 1.0) for a, others in FRIENDS.items() for b in others]
    return (
        spark.createDataFrame(members, "id bigint, category string"),
        spark.createDataFrame(friends, "src bigint, dst bigint, w double"),
    )
