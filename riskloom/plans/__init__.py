"""Lazy DataFrame plans: layers, marts, reports, features, scoring and policies."""
