"""The live path in Structured Streaming."""
