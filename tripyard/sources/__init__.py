"""Inputs and outputs: table readers, test-data carriers, partitioned sinks."""
