"""Settings of an S3-compatible object store, from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping


def object_store_conf(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Session settings for an s3a:// lakehouse root, to pass to `build_session`."""
    endpoint = f"{env.get('MINIO_HOST', 'localhost')}:{env.get('MINIO_PORT', '9000')}"
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.endpoint.region": env.get("AWS_DEFAULT_REGION", "us-east-1"),
        "spark.hadoop.fs.s3a.access.key": env["AWS_ACCESS_KEY_ID"],
        "spark.hadoop.fs.s3a.secret.key": env["AWS_SECRET_ACCESS_KEY"],
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }


def lakehouse_root(env: Mapping[str, str] = os.environ) -> str:
    return f"s3a://{env.get('LAKEHOUSE_BUCKET', 'lakehouse')}"
