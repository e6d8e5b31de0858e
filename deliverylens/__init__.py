"""deliverylens: AI-delivery telemetry analytics and corpus preparation on Spark."""
