"""flowguard: Spark-native analytics for labelled network-flow tables.

Cleaning, profiling, exact stratified sampling, class balancing, two-stage
(attack / attack family) detectors on Spark ML, recall-driven threshold
search, cascade scoring and reports -- all as DataFrame transformations.
"""

__version__ = "0.1.0"
