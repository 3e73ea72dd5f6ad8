"""Training-data operators (documents, pages, benchmark) built on Spark."""
