"""walletscope: wallet-activity analytics as Spark DataFrame, SQL and streaming jobs."""
