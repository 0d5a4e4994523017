"""Column builders: plain functions from ``Column`` to ``Column``, all native expressions."""
