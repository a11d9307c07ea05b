"""Feature matrix, neighbours, learners and evaluation."""
