"""Jobs that combine operators: dimensions, facts, marts, and the registered queries."""
