"""clickwise: Spark-native click-prediction features and scoring."""
