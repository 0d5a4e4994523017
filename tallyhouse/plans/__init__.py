"""The business jobs as lazy plans; reading and writing is left to ``jobs``."""
