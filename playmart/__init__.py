"""playmart: a Spark-native batch mart for game catalogue, daily player
activity and review data (ingest, data-quality gate, fact and analytics
models) built from DataFrame operators."""

__version__ = "0.1.0"
