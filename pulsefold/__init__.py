"""pulsefold: glucose-sensor telemetry analytics and federated learning on Spark."""
