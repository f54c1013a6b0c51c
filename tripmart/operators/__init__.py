"""DataFrame operators of the Bronze -> Silver -> Gold flow."""
