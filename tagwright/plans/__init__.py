"""Compositions of operators: training, the labeling loop, one learner per class."""
