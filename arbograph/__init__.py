"""File-system inventories on Spark: select a subtree, validate it, roll usage up by folder, publish a report."""
