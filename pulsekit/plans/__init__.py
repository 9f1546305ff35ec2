"""Plans: the reference's sixteen jobs as DataFrame pipelines, and the driver catalog."""
