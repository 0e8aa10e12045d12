"""Plan shapes that keep hot keys spread over the cluster."""
