"""The jobs: read, plan, write. The only place with actions on whole tables."""
