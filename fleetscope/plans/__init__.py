"""Named query plans (Spark side) and their independent SQL oracles."""
