"""Sample logs, registered queries and their SQL counterparts."""
