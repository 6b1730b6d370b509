"""Training-data operators: each module holds one operator, :mod:`spindle.llm.entries` the registered queries."""
