"""DataFrame operators over line telemetry."""
