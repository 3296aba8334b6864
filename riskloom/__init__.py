"""riskloom: card-transaction analytics and fraud risk as Spark DataFrame jobs."""
