"""DataFrame -> DataFrame operators of the telemetry engine."""
