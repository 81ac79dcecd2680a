"""Training-data pipeline operators (see README, section "Training-data operators")."""
