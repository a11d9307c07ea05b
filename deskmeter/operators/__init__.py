"""DataFrame operators of the support desk."""
