"""Scalar functions: Column -> Column, all inside the JVM unless their docstring says otherwise."""
