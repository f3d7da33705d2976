"""Jobs made of several steps, and the registered queries."""
