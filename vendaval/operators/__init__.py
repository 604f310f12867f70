"""DataFrame-to-DataFrame operators. They build plans and run no jobs unless their docstring says so."""
