"""File-drop landing with Structured Streaming."""
