"""Document-table analytics on Spark: geometry, hierarchies, reconciliation and export views."""
