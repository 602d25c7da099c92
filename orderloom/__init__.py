"""orderloom: purchase-order feeds and vendor order documents to keyed invoice tables, on Spark."""
