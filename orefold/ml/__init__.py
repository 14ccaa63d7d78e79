"""Classifiers on tables: features, training, tuning, stored models and scoring, all with Spark ML."""
