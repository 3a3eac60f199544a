"""DataFrame-to-DataFrame steps, each lazy unless its docstring says otherwise."""
