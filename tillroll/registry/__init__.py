"""Named queries over the sample star, and their SQL counterparts."""
