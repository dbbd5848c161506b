"""DataFrame-to-DataFrame operators; all lazy unless their name says ``require``."""
