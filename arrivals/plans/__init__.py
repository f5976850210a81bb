"""Compositions: the four table builds, publishing, and the driver query map."""
