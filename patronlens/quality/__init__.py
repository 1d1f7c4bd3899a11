"""Declarative checks, assertion queries and gates."""
