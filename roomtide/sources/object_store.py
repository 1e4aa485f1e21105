"""Settings for an S3-compatible object store."""

from __future__ import annotations

from urllib.parse import urlparse


def object_store_conf(endpoint: str, key: str | None, secret: str | None) -> dict[str, str]:
    """Session settings for path-style access; TLS follows the scheme of ``endpoint``.

    Fails before any work starts if a credential is missing.
    """
    missing = [name for name, value in (("access key", key), ("secret key", secret)) if not value]
    if missing:
        raise ValueError(f"object store credentials missing: {', '.join(missing)}")
    url = urlparse(endpoint if "://" in endpoint else f"http://{endpoint}")
    prefix = "spark.hadoop.fs.s3a."
    return {
        prefix + "endpoint": url.netloc,
        prefix + "access.key": key,
        prefix + "secret.key": secret,
        prefix + "connection.ssl.enabled": str(url.scheme == "https").lower(),
        prefix + "path.style.access": "true",
    }
