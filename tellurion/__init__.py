"""Device telemetry and governance analytics as Spark DataFrame functions."""

from tellurion.session import configure

__all__ = ["configure"]
