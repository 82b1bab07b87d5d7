"""The stateless cleaning columns on a JSON Lines file stream."""
