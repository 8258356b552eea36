"""S3A access options (IO10): object-store paths are ordinary ``s3a://`` paths.

Values come from the environment (or the caller); there is no default secret.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

REQUIRED = ("S3_ENDPOINT", "S3_ACCESS_KEY", "S3_SECRET_KEY")


def s3a_options(env: dict[str, str] | None = None) -> dict[str, str]:
    """Hadoop S3A settings as ``spark.hadoop.fs.s3a.*`` options.

    ``env`` keys: S3_ENDPOINT, S3_ACCESS_KEY, S3_SECRET_KEY (required),
    S3_PATH_STYLE (default true), S3_SSL (default false), S3_MAX_ATTEMPTS,
    S3_CONNECTION_TIMEOUT_MS.
    """
    env = dict(os.environ if env is None else env)
    missing = [k for k in REQUIRED if not env.get(k)]
    if missing:
        raise ValueError(f"missing S3A settings: {', '.join(missing)}")
    p = "spark.hadoop.fs.s3a."
    return {
        p + "endpoint": env["S3_ENDPOINT"],
        p + "access.key": env["S3_ACCESS_KEY"],
        p + "secret.key": env["S3_SECRET_KEY"],
        p + "path.style.access": env.get("S3_PATH_STYLE", "true"),
        p + "connection.ssl.enabled": env.get("S3_SSL", "false"),
        p + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        p + "attempts.maximum": env.get("S3_MAX_ATTEMPTS", "10"),
        p + "connection.timeout": env.get("S3_CONNECTION_TIMEOUT_MS", "60000"),
        p + "connection.establish.timeout": env.get("S3_CONNECTION_TIMEOUT_MS", "60000"),
    }


def with_s3a(builder: SparkSession.Builder, env: dict[str, str] | None = None
             ) -> SparkSession.Builder:
    """Apply the S3A options to a session builder."""
    for k, v in s3a_options(env).items():
        builder = builder.config(k, v)
    return builder
