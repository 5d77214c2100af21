"""docloom: document-to-records analytics as Spark DataFrame plans."""
