"""Session settings the operators rely on."""

from __future__ import annotations

MIB = 1024 * 1024


def session_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a session whose largest shuffle moves about `shuffle_bytes`.

    Shuffles start with partitions of about 128 MiB and at least two per core; adaptive execution
    merges small ones and splits skewed ones of a join. UTC keeps text stamps free of clock changes.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // (128 * MIB)))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
        "spark.sql.files.maxPartitionBytes": str(128 * MIB),
    }
