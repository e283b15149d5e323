"""Retail feeds derived from the star schema: input of the registered queries, their oracles and the benchmark."""
