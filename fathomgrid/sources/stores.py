"""File stores as tasks open them: the addresses Spark uses, as pyarrow's file systems know them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

_S3_SETTINGS = {
    "endpoint": "fs.s3a.endpoint",
    "region": "fs.s3a.endpoint.region",
    "tls": "fs.s3a.connection.ssl.enabled",
    "provider": "fs.s3a.aws.credentials.provider",
}


@dataclass(frozen=True)
class Address:
    """A folder: the kind of store, the folder in it, and what opening the store takes. Carries no secrets."""

    kind: str
    folder: str
    options: dict = field(default_factory=dict)

    def open(self):
        """The store, as pyarrow opens it. S3 credentials come from the executor's own chain."""
        from pyarrow import fs

        if self.kind == "local":
            return fs.LocalFileSystem()
        if self.kind == "s3":
            return fs.S3FileSystem(**self.options)
        return fs.FileSystem.from_uri(self.options["uri"])[0]


def address(root: str, settings: dict[str, str | None] | None = None) -> Address:
    """Where `root` is. `settings`: endpoint, region, tls and provider of S3, as the session has them."""
    settings = settings or {}
    root = root.rstrip("/")
    if "://" not in root and not re.match(r"^(file|dbfs):/", root):
        return Address("local", root)
    if root.startswith("file:"):
        return Address("local", re.sub(r"^file:/+", "/", root))
    if root.startswith("dbfs:"):
        return Address("local", re.sub(r"^dbfs:/+", "/dbfs/", root))
    scheme, rest = root.split("://", 1)
    if scheme not in ("s3", "s3a", "s3n"):
        # What follows the authority is the path; gs:// buckets are part of it.
        folder = rest if scheme in ("gs", "gcs") else "/" + rest.partition("/")[2]
        return Address("other", folder, {"uri": root})
    options: dict = {}
    endpoint = settings.get("endpoint")
    if endpoint:
        secure = str(settings.get("tls") or "true").lower() != "false" and not endpoint.startswith("http://")
        options["scheme"] = "https" if secure else "http"
        options["endpoint_override"] = re.sub(r"^https?://", "", endpoint)
    if settings.get("region"):
        options["region"] = settings["region"]
    if "Anonymous" in (settings.get("provider") or ""):
        options["anonymous"] = True
    return Address("s3", rest, options)


def settings_of(spark: SparkSession) -> dict[str, str | None]:
    conf = spark._jsc.hadoopConfiguration()
    return {name: conf.get(key) for name, key in _S3_SETTINGS.items()}


def address_in(spark: SparkSession, root: str) -> Address:
    return address(root, settings_of(spark))
