"""The same treatments on a streaming DataFrame."""
