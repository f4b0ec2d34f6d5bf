"""talkweave: comment sentiment and ranked keyword search as Spark DataFrame jobs."""
