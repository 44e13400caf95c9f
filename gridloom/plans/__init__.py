"""Jobs composed from the operators; lazy unless their text says otherwise."""
