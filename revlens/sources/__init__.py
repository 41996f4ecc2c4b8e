"""Readers and writers; every path may be any URI that Spark's file systems know."""
