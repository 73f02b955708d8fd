"""Batch analytics over e-commerce order data, written as Spark DataFrame operators."""
