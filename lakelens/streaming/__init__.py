"""Structured Streaming forms of the routing, chat-state and scoring operators."""
