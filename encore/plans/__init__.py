"""End-to-end flows: preparation, modelling, evaluation."""
