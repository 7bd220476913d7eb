"""End-to-end flows composed of stages, and the registered queries."""
