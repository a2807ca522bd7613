"""The library applied to the given tables: bindings, registered queries and their SQL counterparts."""
