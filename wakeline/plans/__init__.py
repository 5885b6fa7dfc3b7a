"""The products: bronze, silver, staging, gold models, alerts and reports as DataFrame functions."""
