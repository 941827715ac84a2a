"""Analytics for forest inventories and point clouds on Spark."""
