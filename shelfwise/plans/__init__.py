"""End-to-end plans: catalog loading, the batch decision job, query registry."""
