"""The three workloads as compositions of operators."""
