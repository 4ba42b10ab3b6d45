"""Fixed values of the audit log: names that must be exact for results to agree."""

from __future__ import annotations

# Audit event names that are kept, grouped by service.
EVENT_NAMES = [
    "StartInstances", "StopInstances", "RebootInstances", "TerminateInstances", "ModifyInstanceAttribute",
    "CreateTags", "DeleteTags", "RunInstances", "AttachVolume", "DetachVolume", "CreateVolume", "DeleteVolume",
    "ModifyVolume",
    "CreateDBInstance", "DeleteDBInstance", "ModifyDBInstance", "RebootDBInstance", "StartDBInstance",
    "StopDBInstance", "CreateDBSnapshot", "DeleteDBSnapshot", "RestoreDBInstanceFromDBSnapshot", "AddTagsToResource",
    "RemoveTagsFromResource",
    "CreateVpc", "DeleteVpc", "ModifyVpcAttribute", "CreateSubnet", "DeleteSubnet", "ModifySubnetAttribute",
    "CreateRouteTable", "DeleteRouteTable", "CreateInternetGateway", "DeleteInternetGateway", "AttachInternetGateway",
    "DetachInternetGateway", "CreateNatGateway", "DeleteNatGateway",
    "CreateCluster", "DeleteCluster", "ModifyCluster", "RebootCluster", "ResizeCluster", "PauseCluster",
    "ResumeCluster", "RestoreFromClusterSnapshot", "CreateClusterSnapshot", "DeleteClusterSnapshot",
    "CreateBucket", "DeleteBucket", "PutBucketTagging", "PutBucketEncryption", "PutBucketVersioning",
    "PutBucketPolicy", "DeleteBucketPolicy", "PutBucketNotification", "PutPublicAccessBlock", "PutBucketReplication",
    "DeleteBucketReplication", "PutBucketAcl",
    "UpdateClusterConfig", "UpdateClusterVersion", "CreateAddon", "DeleteAddon", "UpdateAddon", "TagResource",
    "UntagResource",
    "CreateRepository", "DeleteRepository", "PutImage", "BatchDeleteImage", "PutRepositoryPolicy",
    "DeleteRepositoryPolicy",
    "CreateKey", "ScheduleKeyDeletion", "CancelKeyDeletion", "EnableKey", "DisableKey", "UpdateKeyDescription",
    "PutKeyPolicy", "CreateAlias", "DeleteAlias", "UpdateAlias",
    "CreateFunction", "DeleteFunction", "UpdateFunctionCode", "UpdateFunctionConfiguration", "PublishVersion",
    "CreateEventSourceMapping", "DeleteEventSourceMapping", "UpdateEventSourceMapping", "PutFunctionConcurrency",
    "DeleteFunctionConcurrency",
    "CreateRestApi", "DeleteRestApi", "UpdateRestApi", "CreateDeployment", "DeleteDeployment", "CreateStage",
    "DeleteStage", "UpdateStage", "CreateApi", "DeleteApi", "UpdateApi", "CreateRoute", "DeleteRoute", "UpdateRoute",
    "CreateIntegration", "DeleteIntegration", "UpdateIntegration",
    "CreateJob", "DeleteJob", "UpdateJob", "StartJobRun", "StopJobRun", "CreateCrawler", "DeleteCrawler",
    "UpdateCrawler", "StartCrawler", "StopCrawler", "CreateDatabase", "DeleteDatabase", "UpdateDatabase",
    "CreateTable", "DeleteTable", "UpdateTable",
    "CreateStack", "DeleteStack", "UpdateStack", "CreateChangeSet", "DeleteChangeSet", "ExecuteChangeSet",
    "CancelUpdateStack", "ContinueUpdateRollback", "UpdateTerminationProtection", "SetStackPolicy",
    "CreateTrail", "DeleteTrail", "UpdateTrail", "StartLogging", "StopLogging", "PutEventSelectors",
    "PutInsightSelectors",
    "CreateAssociation", "DeleteAssociation", "UpdateAssociation", "CreateDocument", "DeleteDocument",
    "UpdateDocument", "SendCommand", "PutComplianceItems",
    "StartQueryExecution", "StopQueryExecution", "CreateWorkGroup", "DeleteWorkGroup", "UpdateWorkGroup",
    "CreateDataCatalog", "DeleteDataCatalog", "UpdateDataCatalog", "BatchCreateNamedQuery", "BatchDeleteNamedQuery",
    "CreateStateMachine", "DeleteStateMachine", "UpdateStateMachine", "StartExecution", "StopExecution",
    "CreateActivity", "DeleteActivity",
    "CreateServer", "DeleteServer", "UpdateServer", "StartServer", "StopServer", "CreateUser", "DeleteUser",
    "UpdateUser",
    "CreatePipeline", "DeletePipeline", "UpdatePipeline", "StartPipelineExecution", "StopPipelineExecution",
    "RetryStageExecution",
    "RunJobFlow", "TerminateJobFlows", "ModifyInstanceGroups", "AddInstanceGroups", "SetTerminationProtection",
    "AddJobFlowSteps",
]

# Event source -> resource type.
RESOURCE_TYPES = {
    "ec2.amazonaws.com": "EC2",
    "rds.amazonaws.com": "RDS",
    "redshift.amazonaws.com": "Redshift",
    "s3.amazonaws.com": "S3",
    "eks.amazonaws.com": "EKS",
    "ecr.amazonaws.com": "ECR",
    "kms.amazonaws.com": "KMS",
    "lambda.amazonaws.com": "LAMBDA",
    "apigateway.amazonaws.com": "API-GATEWAY",
    "glue.amazonaws.com": "GLUE",
    "cloudformation.amazonaws.com": "CLOUDFORMATION",
    "cloudtrail.amazonaws.com": "CLOUDTRAIL",
    "ssm.amazonaws.com": "SSM",
    "athena.amazonaws.com": "ATHENA",
    "states.amazonaws.com": "STEP-FUNCTIONS",
    "transfer.amazonaws.com": "TRANSFER-FAMILY",
    "codepipeline.amazonaws.com": "CODEPIPELINE",
    "elasticmapreduce.amazonaws.com": "EMR",
}

# Builds and distributions have entries in FIELD_EVENTS, so their events are kept and typed as well.
RESOURCE_TYPES |= {"codebuild.amazonaws.com": "CODEBUILD", "cloudfront.amazonaws.com": "CLOUDFRONT"}

# Fixed rule: every typed source is kept except the audit service's own.
EVENT_SOURCES = [s for s in RESOURCE_TYPES if s != "cloudtrail.amazonaws.com"]

# Request fields that name the resource, by source, in order of preference.
REQUEST_FIELDS = {
    "ec2.amazonaws.com": ["instanceId", "volumeId", "vpcId", "subnetId", "groupId"],
    "rds.amazonaws.com": ["dBInstanceIdentifier", "dBClusterIdentifier"],
    "redshift.amazonaws.com": ["clusterIdentifier"],
    "s3.amazonaws.com": ["bucketName", "bucket"],
    "eks.amazonaws.com": ["name", "clusterName"],
    "ecr.amazonaws.com": ["repositoryName"],
    "kms.amazonaws.com": ["keyId"],
    "lambda.amazonaws.com": ["functionName"],
    "apigateway.amazonaws.com": ["restApiId", "apiId", "id"],
    "glue.amazonaws.com": ["jobName", "name", "crawlerName", "databaseName", "tableName"],
    "cloudformation.amazonaws.com": ["stackName", "changeSetName"],
    "cloudtrail.amazonaws.com": ["trailName", "name"],
    "ssm.amazonaws.com": ["associationId", "documentName", "instanceId"],
    "athena.amazonaws.com": ["queryExecutionId", "workGroupName", "dataCatalogName"],
    "states.amazonaws.com": ["stateMachineArn", "executionArn", "activityArn"],
    "transfer.amazonaws.com": ["serverId", "userName", "workflowId"],
    "codepipeline.amazonaws.com": ["pipelineName", "executionId", "stageName"],
    "elasticmapreduce.amazonaws.com": ["clusterId", "jobFlowId", "stepId"],
}

# Response fields that name the resource, in order of preference.
RESPONSE_FIELDS = [
    "instanceId", "dBInstanceIdentifier", "clusterIdentifier", "vpcId", "subnetId",
    "bucketName", "name", "keyId", "functionName",
]

# Keys that look like a resource id or name but are not.
NOT_RESOURCE_KEYS = ["requestId", "eventId", "eventName", "userName", "principalId"]

# Id prefixes and sources of the valid-resource predicate.
RESOURCE_ID_PREFIXES = ["i-", "vpc-", "subnet-", "vol-", "snap-", "igw-", "nat-", "rtb-"]
NAMED_RESOURCE_SOURCES = [
    "rds.amazonaws.com", "redshift.amazonaws.com", "s3.amazonaws.com", "eks.amazonaws.com",
    "ecr.amazonaws.com", "kms.amazonaws.com", "lambda.amazonaws.com",
]

# Functions installed by the vendor, whose changes are not recorded.
SYSTEM_FUNCTIONS = [
    "aws-controltower-NotificationForwarder",
    "aws-controltower-ConfigComplianceCheck",
    "aws-controltower-BaselineCloudTrail",
    "nops-register-aws-account",
    "generate-external-id",
    "CidInitialSetup-DoNotRun",
    "CidCustomResourceDashboard",
    "CidCustomResourceFunctionInit-DoNotRun",
    "CidCustomResourceProcessPath-DoNotRun",
    "cid-CID-Analytics",
    "cid-CID-Analytics-DataExports",
    "AWS-Cost-Reporting-Lambda",
]

# Service and field -> events that can change the field.
FIELD_EVENTS = {
    "EC2": {
        "instancename": ["CreateTags", "DeleteTags"],
        "instancetype": ["ModifyInstanceAttribute"],
        "state": ["StartInstances", "StopInstances", "RebootInstances", "TerminateInstances"],
        "iamrole": ["AssociateIamInstanceProfile", "DisassociateIamInstanceProfile", "TerminateInstances"],
        "securitygroups": [
            "ModifyInstanceAttribute", "AuthorizeSecurityGroupIngress", "StartInstances", "StopInstances", "TerminateInstances",
        ],
        "publicip": [
            "AssociateAddress", "DisassociateAddress", "StartInstances", "StopInstances", "TerminateInstances",
        ],
        "privateip": ["ModifyInstanceAttribute", "StartInstances", "StopInstances", "TerminateInstances"],
        "vpc": ["ModifyInstanceAttribute", "StartInstances", "StopInstances", "TerminateInstances"],
        "subnet": ["ModifyInstanceAttribute", "StartInstances", "StopInstances", "TerminateInstances"],
        "storagevolumes": ["AttachVolume", "DetachVolume"],
    },
    "VPC": {
        "vpc_name": ["CreateTags", "DeleteTags"],
        "state": ["CreateVpc", "DeleteVpc"],
        "subnets": ["CreateSubnet", "DeleteSubnet"],
        "security_groups": ["CreateSecurityGroup", "DeleteSecurityGroup"],
        "network_acls": ["CreateNetworkAcl", "DeleteNetworkAcl"],
        "internet_gateways": ["CreateInternetGateway", "AttachInternetGateway", "DetachInternetGateway"],
        "vpn_connections": ["CreateVpnConnection", "DeleteVpnConnection"],
        "vpc_endpoints": ["CreateVpcEndpoint", "DeleteVpcEndpoint"],
        "vpc_peerings": ["CreateVpcPeeringConnection", "DeleteVpcPeeringConnection"],
        "route_rules": ["CreateRouteTable", "DeleteRouteTable"],
    },
    "CODEBUILD": {
        "source_provider": ["UpdateProject"],
        "repository": ["UpdateProject"],
        "description": ["UpdateProject"],
        "last_modified": ["StartBuild", "UpdateProject"],
    },
    "EKS": {
        "clustername": ["CreateCluster", "UpdateClusterConfig"],
        "status": ["CreateCluster", "DeleteCluster", "UpdateClusterConfig"],
        "kubernetesversion": ["UpdateClusterVersion"],
        "supportperiod": ["UpdateClusterConfig"],
        "addons": ["CreateAddon", "DeleteAddon", "UpdateAddon"],
        "tags": ["TagResource", "UntagResource"],
    },
    "GLUE": {
        "job_name": ["CreateJob", "UpdateJob"],
        "type": ["CreateJob", "UpdateJob"],
        "domain": ["CreateJob", "UpdateJob"],
        "created_by": ["CreateJob", "UpdateJob"],
        "glue_version": ["UpdateJob"],
    },
    "API-GATEWAY": {
        "name": ["CreateRestApi", "UpdateRestApi", "CreateApi", "UpdateApi"],
        "description": ["UpdateRestApi", "UpdateApi"],
        "protocol": ["CreateApi", "UpdateApi"],
        "endpoint_type": ["UpdateRestApi", "UpdateApi"],
        "created_date": ["CreateRestApi", "CreateApi"],
    },
    "CODEPIPELINE": {
        "pipeline_name": ["CreatePipeline", "UpdatePipeline"],
        "last_execution_status": ["StartPipelineExecution", "StopPipelineExecution"],
        "latest_source_revisions": ["StartPipelineExecution"],
        "last_execution_started": ["StartPipelineExecution"],
    },
    "REDSHIFT": {
        "database_name": ["CreateCluster", "ModifyCluster"],
        "node_type": ["CreateCluster", "ModifyCluster"],
        "node_count": ["ResizeCluster", "ModifyCluster"],
        "engine_version": ["ModifyCluster"],
        "storage_size": ["ModifyCluster"],
        "status": ["CreateCluster", "DeleteCluster", "PauseCluster", "ResumeCluster", "RebootCluster"],
        "endpoint": ["CreateCluster", "ModifyCluster"],
        "port": ["CreateCluster", "ModifyCluster"],
        "replication": ["CreateCluster", "ModifyCluster"],
    },
    "RDS": {
        "dbname": ["CreateDBInstance", "ModifyDBInstance"],
        "enginetype": ["CreateDBInstance"],
        "engineversion": ["ModifyDBInstance"],
        "storagesize": ["ModifyDBInstance"],
        "instancetype": ["ModifyDBInstance"],
        "status": ["StartDBInstance", "StopDBInstance", "RebootDBInstance", "CreateDBInstance", "DeleteDBInstance"],
        "endpoint": ["CreateDBInstance", "ModifyDBInstance"],
        "port": ["CreateDBInstance", "ModifyDBInstance"],
        "hasreplica": ["CreateDBInstanceReadReplica", "DeleteDBInstance"],
    },
    "SUBNET": {
        "vpcname": ["CreateTags", "DeleteTags"],
        "state": ["CreateSubnet", "DeleteSubnet"],
        "securitygroups": ["ModifyNetworkInterfaceAttribute", "AuthorizeSecurityGroupIngress"],
        "acls": ["CreateNetworkAcl", "DeleteNetworkAcl", "ReplaceNetworkAclAssociation"],
        "internetgateways": ["CreateInternetGateway", "AttachInternetGateway", "DetachInternetGateway"],
        "vpnconnections": ["CreateVpnConnection", "DeleteVpnConnection"],
        "vpceendpoints": ["CreateVpcEndpoint", "DeleteVpcEndpoint"],
        "vpcpeerings": ["CreateVpcPeeringConnection", "DeleteVpcPeeringConnection"],
        "routetables": ["CreateRouteTable", "AssociateRouteTable", "DisassociateRouteTable"],
        "subnetname": ["CreateTags", "DeleteTags"],
    },
    "LAMBDA": {
        "functionname": ["CreateFunction", "UpdateFunctionConfiguration"],
        "description": ["UpdateFunctionConfiguration"],
        "handler": ["UpdateFunctionConfiguration"],
        "runtime": ["UpdateFunctionConfiguration"],
        "memorysize": ["UpdateFunctionConfiguration"],
        "timeout": ["UpdateFunctionConfiguration"],
        "role": ["UpdateFunctionConfiguration"],
        "environment": ["UpdateFunctionConfiguration"],
        "vpcconfig": ["UpdateFunctionConfiguration"],
        "tags": ["TagResource", "UntagResource"],
    },
    "ECR": {
        "repositoryname": ["CreateRepository", "DeleteRepository"],
        "businessappid": ["TagResource", "UntagResource"],
        "repositorysize": ["PutImage", "BatchDeleteImage"],
        "imagetags": ["PutImage", "BatchDeleteImage"],
    },
    "KMS": {
        "keyname": ["CreateKey", "UpdateKeyDescription"],
        "estado": ["EnableKey", "DisableKey"],
        "keytype": ["CreateKey"],
        "tags": ["TagResource", "UntagResource"],
    },
    "CLOUDFRONT": {
        "distributionname": ["CreateTags", "DeleteTags"],
        "status": ["UpdateDistribution"],
        "domainname": ["UpdateDistribution"],
        "origins": ["UpdateDistribution"],
        "defaultcachebehavior": ["UpdateDistribution"],
        "cachebehaviors": ["UpdateDistribution"],
        "comment": ["UpdateDistribution"],
        "priceclass": ["UpdateDistribution"],
        "enabled": ["UpdateDistribution"],
        "webacl": ["UpdateDistribution"],
    },
}


def field_events() -> list[tuple[str, str, str]]:
    """(service_type, field_name, event_name) triples of the table above."""
    return [
        (service, field, event)
        for service, fields in FIELD_EVENTS.items()
        for field, events in fields.items()
        for event in events
    ]


def kept_event_names() -> list[str]:
    """The names kept at ingest: the list above and every event a field can be attributed to."""
    return sorted(set(EVENT_NAMES) | {event for _, _, event in field_events()})
