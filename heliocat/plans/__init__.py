"""Read queries, load pipelines and report series built from the operators."""
