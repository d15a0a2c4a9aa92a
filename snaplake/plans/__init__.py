"""Registry plans: silver staging, gold marts, the pipeline runner."""
