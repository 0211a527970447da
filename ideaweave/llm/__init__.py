"""Operators for cleaning and mixing large text collections (see README, "Text pipeline")."""
